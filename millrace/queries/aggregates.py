"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators import aggregates, columns
from millrace.queries.registry import query, table, texts
from millrace.sources import files, sinks

_WORDS = """
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    GROUP BY word"""


@query("word_count", _WORDS)
def word_count(spark, sf_dir):
    words = columns.explode_words(texts(spark, sf_dir, "text"), "text")
    return aggregates.word_counts(words)


@query("word_count_rdd", _WORDS)
def word_count_rdd(spark, sf_dir):
    return aggregates.word_counts_functional(texts(spark, sf_dir, "text"))


@query("word_count_sql", """
    SELECT word, count(word) AS n
    FROM (SELECT nullif(string_split(name, ' ')[1], '') AS word
          FROM (SELECT p_name AS name FROM part UNION ALL SELECT o_orderpriority FROM orders))
    GROUP BY word""")
def word_count_sql(spark, sf_dir):
    path = scratch.new_path(spark, "first-words")
    sinks.write_lines(table(spark, sf_dir, "part").select("p_name"), path)
    sinks.write_lines(table(spark, sf_dir, "orders").select("o_orderpriority"), path, mode="append")
    view = scratch.new_name("word_counts")
    # One declared column: the reader keeps the first field of each line.
    files.file_view(spark, view, path, columns="word STRING", delimiter=" ")
    return spark.sql(f"SELECT word, count(word) AS n FROM {view} GROUP BY word")


@query("agg_count", "SELECT count(*) AS n FROM lineitem")
def agg_count(spark, sf_dir):
    return spark.sql(f"SELECT count(*) AS n FROM parquet.`{sf_dir}/lineitem.parquet`")


@query("agg_global_max", "SELECT max(l_extendedprice) AS top_price, max(l_shipdate) AS last_ship FROM lineitem")
def agg_global_max(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(
        F.max("l_extendedprice").alias("top_price"), F.max("l_shipdate").alias("last_ship")
    )


@query("agg_multi_key_count", """
    SELECT l_suppkey, l_returnflag, l_linestatus, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL""")
def agg_multi_key_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(
        "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity"
    ).agg(F.count("*").alias("n"))


@query("agg_max_avg", """
    SELECT month(o_orderdate)::INTEGER AS month, max(o_orderpriority) AS top_priority,
           max(o_orderstatus) AS top_status, round(avg(o_totalprice), 4) AS avg_price
    FROM orders GROUP BY 1 ORDER BY avg_price DESC""")
def agg_max_avg(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.month("o_orderdate").alias("month"))
        .agg(
            F.max("o_orderpriority").alias("top_priority"),
            F.max("o_orderstatus").alias("top_status"),
            F.round(F.avg("o_totalprice"), 4).alias("avg_price"),
        )
        .orderBy(F.desc("avg_price"))
    )


@query("agg_distinct", "SELECT DISTINCT p_name, p_type FROM part")
def agg_distinct(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_name", "p_type").distinct()


@query("agg_dedupe", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""")
def agg_dedupe(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
        "l_extendedprice",
    )
    return aggregates.dedupe(
        rows, ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
    )


@query("agg_dup_report", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def agg_dup_report(spark, sf_dir):
    return aggregates.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _numeric(table_name: str, c: str) -> str:
    return f"""
    SELECT '{c}' AS column_name, 'count' AS stat, CAST(count({c}) AS DOUBLE) AS number, NULL::VARCHAR AS text FROM {table_name}
    UNION ALL SELECT '{c}', 'mean', round(avg({c}), 6), NULL FROM {table_name}
    UNION ALL SELECT '{c}', 'stddev', round(stddev_samp({c}), 6), NULL FROM {table_name}
    UNION ALL SELECT '{c}', 'min', CAST(min({c}) AS DOUBLE), NULL FROM {table_name}
    UNION ALL SELECT '{c}', 'max', CAST(max({c}) AS DOUBLE), NULL FROM {table_name}"""


def _text(table_name: str, c: str) -> str:
    return f"""
    SELECT '{c}' AS column_name, 'count' AS stat, CAST(count({c}) AS DOUBLE) AS number, NULL::VARCHAR AS text FROM {table_name}
    UNION ALL SELECT '{c}', 'min', NULL, min({c}) FROM {table_name}
    UNION ALL SELECT '{c}', 'max', NULL, max({c}) FROM {table_name}"""


@query("agg_describe", " UNION ALL ".join(
    [_numeric("lineitem", c) for c in ("l_orderkey", "l_quantity", "l_extendedprice", "l_discount")]
    + [_text("lineitem", "l_returnflag")]))
def agg_describe(spark, sf_dir):
    return aggregates.describe(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"],
    )


@query("agg_null_counts", """
    WITH e AS (SELECT event_id, nullif(event_type, 'error') AS event_type,
                      CASE WHEN value > 100 THEN value END AS value, user_id FROM events)
    SELECT 'event_id' AS column_name, count(*) - count(event_id) AS nulls FROM e
    UNION ALL SELECT 'event_type', count(*) - count(event_type) FROM e
    UNION ALL SELECT 'value', count(*) - count(value) FROM e
    UNION ALL SELECT 'user_id', count(*) - count(user_id) FROM e""")
def agg_null_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") > 100, F.col("value")).alias("value"),
        "user_id",
    )
    return aggregates.null_counts(events)


@query("agg_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def agg_shape(spark, sf_dir):
    return aggregates.shape(table(spark, sf_dir, "lineitem"))

"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import parsing
from millrace.queries.registry import query, table


@query("fn_split", """
    SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word,
           CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_words FROM part""")
def fn_split(spark, sf_dir):
    words = F.split("p_name", " ")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.get(words, 0).alias("first_word"), F.size(words).alias("n_words")
    )


@query("fn_trim", "SELECT page_id, trim('  ' || url || ' ') AS url FROM pages")
def fn_trim(spark, sf_dir):
    padded = F.concat(F.lit("  "), "url", F.lit(" "))
    return table(spark, sf_dir, "pages").select("page_id", F.trim(padded).alias("url"))


@query("fn_try_cast", """
    SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS level,
           TRY_CAST(o_orderstatus || CAST(o_custkey AS VARCHAR) AS DOUBLE) AS bad,
           TRY_CAST(CAST(o_custkey AS VARCHAR) AS FLOAT) AS customer
    FROM orders""")
def fn_try_cast(spark, sf_dir):
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("level"),
        F.concat("o_orderstatus", F.col("o_custkey").cast("string")).alias("bad"),
        F.col("o_custkey").cast("string").alias("customer"),
    )
    return text.select(
        "o_orderkey",
        parsing.to_type("level", "int").alias("level"),
        parsing.to_type("bad", "double").alias("bad"),
        parsing.to_type("customer", "float").alias("customer"),
    )


@query("fn_to_timestamp", """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('minute', ts) END AS at
    FROM events""")
def fn_to_timestamp(spark, sf_dir):
    text = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("1/1/24 9:5"))
        .otherwise(F.date_format("ts", "dd/M/yy HH:mm"))
        .alias("at"),
    )
    return text.withColumn("at", parsing.to_time("at").cast("timestamp_ntz"))


@query("fn_date_parts", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders""")
def fn_date_parts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.month("o_orderdate").alias("month")
    )


@query("fn_from_json", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def fn_from_json(spark, sf_dir):
    parsed = table(spark, sf_dir, "events").select(
        "event_id", parsing.from_message("props", "k int").alias("message")
    )
    return parsed.select("event_id", "message.*")


@query("fn_to_json", """
    SELECT CAST(c_custkey AS VARCHAR) AS key, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer""")
def fn_to_json(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    messages = parsing.to_message(customer, "c_custkey")
    parsed = messages.select("key", parsing.from_message("value", customer.schema).alias("m"))
    return parsed.select("key", "m.*")


@query("fn_rand", """
    SELECT c_custkey, true AS in_range,
           round(CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 7) AS BIGINT) / 268435456.0::DOUBLE * c_custkey * 10000, 2) AS salary
    FROM customer""")
def fn_rand(spark, sf_dir):
    """A seeded random share of id * 10000, and the same arithmetic with a hash in its place."""
    drawn = F.rand(10) * F.col("c_custkey") * 10000
    share = F.conv(F.substring(F.md5(F.col("c_custkey").cast("string")), 1, 7), 16, 10).cast("double") / 268435456
    return table(spark, sf_dir, "customer").select(
        "c_custkey", drawn.between(0, F.col("c_custkey") * 10000).alias("in_range"),
        F.round(share * F.col("c_custkey") * 10000, 2).alias("salary"),
    )


@query("fn_case", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O' THEN 'open'
      ELSE 'part' END AS state FROM orders""")
def fn_case(spark, sf_dir):
    status = F.col("o_orderstatus")
    state = F.when(status == "F", "done").when(status == "O", "open").otherwise("part")
    return table(spark, sf_dir, "orders").select("o_orderkey", state.alias("state"))


@query("fn_fill_null", """
    SELECT event_id, nullif(event_type, 'error') AS event_type,
           coalesce(CASE WHEN value > 100 THEN value END, 0) AS value FROM events""")
def fn_fill_null(spark, sf_dir):
    holes = table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") > 100, F.col("value")).alias("value"),
    )
    return parsing.zero_for_null(holes)

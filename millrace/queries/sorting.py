"""Sort, top-k, preview."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import columns
from millrace.queries.registry import query, table


@query("sort_desc", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey""")
def sort_desc(spark, sf_dir):
    # The key breaks ties, so one frequent price does not become one range.
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey"
    )


@query("top_k", """
    SELECT l_orderkey, l_partkey, l_shipdate, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_shipdate LIMIT 100""")
def top_k(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_partkey", "l_shipdate", "l_extendedprice")
        .orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_partkey", "l_shipdate")
        .limit(100)
    )


@query("preview_rows", """
    SELECT least(1000, count(*)) AS n, least(1000, count(*)) AS known FROM orders""")
def preview_rows(spark, sf_dir):
    """The first rows of a table, all of them rows of the table."""
    orders = table(spark, sf_dir, "orders")
    first = spark.createDataFrame(columns.preview(orders), orders.schema)
    known = first.join(orders.withColumn("known", F.lit(1)), orders.columns, "left")
    return known.agg(F.count("*").alias("n"), F.count("known").alias("known"))

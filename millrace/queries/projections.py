"""Projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import columns
from millrace.queries.registry import query, table


@query("proj_select", "SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem")
def proj_select(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"
    )


@query("proj_struct_expand", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def proj_struct_expand(spark, sf_dir):
    nested = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.struct("o_custkey", "o_totalprice", "o_orderdate").alias("head")
    )
    return columns.expand_struct(nested, "head", "o_orderkey")


@query("proj_select_expr", """
    SELECT l_orderkey AS invoice_num, CAST(l_partkey AS VARCHAR) AS stock_code,
           CAST(l_quantity AS INTEGER) AS quantity,
           round(l_extendedprice / l_quantity, 8) AS unit_price, l_shipdate AS "ship-date"
    FROM lineitem""")
def proj_select_expr(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS invoice_num",
        "CAST(l_partkey AS STRING) AS stock_code",
        "CAST(l_quantity AS INT) AS quantity",
        "round(l_extendedprice / l_quantity, 8) AS unit_price",
        "l_shipdate AS `ship-date`",
    )


@query("proj_with_column", """
    SELECT p_partkey, upper(p_name) AS p_name, p_retailprice,
           round(p_retailprice * 1.1, 4) AS with_tax
    FROM part""")
def proj_with_column(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice").withColumns(
        {
            "p_name": F.upper("p_name"),
            "with_tax": F.round(F.col("p_retailprice") * F.lit(1.1), 4),
        }
    )


@query("proj_rename", """
    SELECT n_nationkey AS country_id, n_name AS country_name, n_regionkey AS region_id FROM nation""")
def proj_rename(spark, sf_dir):
    return columns.rename_and_drop(
        table(spark, sf_dir, "nation"),
        {"n_nationkey": "country_id", "n_name": "country_name", "n_regionkey": "region_id",
         "not there": "ignored"},
    )


@query("proj_drop", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def proj_drop(spark, sf_dir):
    return columns.rename_and_drop(
        table(spark, sf_dir, "orders"),
        drops=("o_orderstatus", "o_orderdate", "o_orderpriority", "fn_wt"),
    )


@query("proj_literal", """
    SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS customer_id, 2 AS version, 'load' AS step
    FROM customer""")
def proj_literal(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.lit(2).alias("version"),
        F.lit("load").alias("step"),
    )


@query("row_id", """
    SELECT l_linenumber, count(*) AS n_rows, count(*) AS n_ids FROM lineitem GROUP BY l_linenumber""")
def row_id(spark, sf_dir):
    # Ids are unique over the frame, so each group holds as many ids as rows.
    numbered = columns.row_ids(table(spark, sf_dir, "lineitem").select("l_linenumber"))
    once = numbered.groupBy("id").agg(F.min("l_linenumber").alias("l_linenumber"),
                                      F.count("*").alias("n_rows"))
    return once.groupBy("l_linenumber").agg(
        F.sum("n_rows").alias("n_rows"), F.count("*").alias("n_ids")
    )


@query("explode_words", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def explode_words(spark, sf_dir):
    return columns.explode_words(table(spark, sf_dir, "part"), "p_name", "p_partkey")

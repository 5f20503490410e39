"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators import joins, sets
from millrace.queries.registry import query, table
from millrace.sources import sinks

ROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
       "l_quantity", "l_extendedprice"]


@query("join_left_outer", """
    SELECT o_orderkey, o_custkey, c_name, c_mktsegment
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
      ON o_custkey = c_custkey""")
def join_left_outer(spark, sf_dir):
    some = table(spark, sf_dir, "customer").where("c_mktsegment IN ('BUILDING', 'MACHINERY')")
    return joins.join_on(
        table(spark, sf_dir, "orders"), some, [("o_custkey", "c_custkey")], "left_outer"
    ).select("o_orderkey", "o_custkey", "c_name", "c_mktsegment")


@query("join_salted", """
    WITH l AS (SELECT CASE WHEN l_linestatus = 'F' THEN 0 ELSE l_orderkey END AS k, l_quantity FROM lineitem),
    o AS (SELECT o_orderkey AS k, o_orderstatus AS meaning FROM orders WHERE o_orderpriority <> '1-URGENT'
          UNION ALL SELECT 0, r_name FROM region
          UNION ALL SELECT -1, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT l.k = 0 AS hot, meaning, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty
    FROM l LEFT JOIN o ON l.k = o.k GROUP BY ALL""")
def join_salted(spark, sf_dir):
    """Half of the left rows share a key, a fifth of the right rows another one; lines of
    urgent orders have no partner."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linestatus") == "F", F.lit(0)).otherwise(F.col("l_orderkey")).alias("k"), "l_quantity")
    orders = table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    names = orders.where(~urgent).select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("meaning"))
    names = names.union(table(spark, sf_dir, "region").select(F.lit(0).cast("long"), "r_name"))
    names = names.union(orders.where(urgent).select(F.lit(-1).cast("long"), "o_orderstatus"))
    joined = joins.salted_join(lines, names, [("k", "key")], "left")
    return joined.groupBy((F.col("k") == 0).alias("hot"), "meaning").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("sum_qty")
    )


_ZIPPED = """
    WITH l AS (
      SELECT l_orderkey, l_partkey, l_quantity, row_number() OVER (
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
                 l_extendedprice) - 1 AS idx
      FROM lineitem),
    o AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS k FROM orders)
    SELECT idx, l_orderkey, l_partkey, l_quantity, o_orderkey, o_totalprice
    FROM l LEFT JOIN o ON idx = k"""


@query("join_positional", _ZIPPED)
def join_positional(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*ROW)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return joins.positional_join(lines, orders, ROW, ["o_orderkey"]).select(
        "idx", "l_orderkey", "l_partkey", "l_quantity", "o_orderkey", "o_totalprice"
    )


@query("join_federated", """
    SELECT s_name, s_nationkey, c_acctbal AS salary
    FROM supplier JOIN customer ON s_suppkey = c_custkey ORDER BY salary DESC, s_name""")
def join_federated(spark, sf_dir):
    salary = f"{scratch.work_database(spark)}.{scratch.new_name('salary')}"
    sinks.save_table(
        table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_acctbal AS salary"),
        salary, fmt="csv",
    )
    people = scratch.new_name("people")
    table(spark, sf_dir, "supplier").createOrReplaceTempView(people)
    return spark.sql(
        f"SELECT p.s_name, p.s_nationkey, s.salary FROM {salary} s JOIN {people} p "
        "ON p.s_suppkey = s.id ORDER BY s.salary DESC, p.s_name"
    )


@query("join_broadcast", """
    SELECT n_name, max(c_name) AS last_name, round(avg(c_acctbal), 6) AS avg_bal
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def join_broadcast(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    joined = joins.broadcast_join(
        table(spark, sf_dir, "customer"), nation, [("c_nationkey", "n_nationkey")]
    )
    return joined.groupBy("n_name").agg(
        F.max("c_name").alias("last_name"), F.round(F.avg("c_acctbal"), 6).alias("avg_bal")
    )


@query("union_positional", """
    SELECT o_orderkey AS id, o_totalprice AS amount FROM orders
    UNION ALL SELECT c_custkey, c_acctbal FROM customer
    UNION ALL SELECT o_orderkey, o_totalprice FROM orders""")
def union_positional(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_totalprice AS amount")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return sets.union_by_position(orders, customers, orders)


@query("serving_union", """
    SELECT count(*) AS n, count(DISTINCT event_id) AS n_ids
    FROM (SELECT event_id FROM events UNION ALL SELECT event_id FROM events)""")
def serving_union(spark, sf_dir):
    batch = table(spark, sf_dir, "events")
    speed = batch.withColumn("EventTime", F.col("ts")).withColumn("EventDate", F.to_date("ts"))
    name = scratch.new_name("retail_global")
    sets.serving_view(batch, speed, name, drop=("EventTime", "EventDate"))
    return spark.sql(
        f"SELECT count(*) AS n, count(DISTINCT event_id) AS n_ids FROM global_temp.{name}"
    )

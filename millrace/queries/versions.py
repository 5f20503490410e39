"""Versioned tables and catalog statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators import ddl
from millrace.operators.keyed import KeyedTable
from millrace.operators.versioned import SchemaMismatch, VersionedTable
from millrace.queries.registry import query, table
from millrace.sources import sinks


def _table_of(spark, df, *keys: str) -> VersionedTable:
    versions = VersionedTable(spark, scratch.new_path(spark, "vt"), keys)
    versions.create(df)
    return versions


@query("vt_write_read", """
    SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'P'""")
def vt_write_read(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderkey", "o_totalprice", "o_orderdate"]
    versions = _table_of(spark, orders.select(*columns))
    versions.append(orders.where("o_orderstatus = 'P'").select(*columns))
    return versions.read()


@query("vt_enforce", "SELECT 'o_custkey' AS wrong_column, 0::BIGINT AS version, count(*) AS n FROM orders")
def vt_enforce(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    versions = _table_of(spark, orders)
    wrong = ""
    try:
        versions.append(orders.withColumn("o_custkey", F.col("o_custkey").cast("string")))
    except SchemaMismatch as refused:
        wrong = str(refused).rpartition(" ")[2]
    return versions.read().agg(F.count("*").alias("n")).select(
        F.lit(wrong).alias("wrong_column"),
        F.lit(versions.current_version()).cast("bigint").alias("version"), "n",
    )


@query("vt_evolve", """
    SELECT c_custkey, NULL::VARCHAR AS c_mktsegment FROM customer
    UNION ALL SELECT c_custkey, c_mktsegment FROM customer""")
def vt_evolve(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    versions = _table_of(spark, customer.select("c_custkey"))
    versions.append(customer.select("c_custkey", "c_mktsegment"), merge_schema=True)
    return versions.read()


@query("vt_update", """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_totalprice > 100000 THEN 'BIG' ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice
    FROM orders""")
def vt_update(spark, sf_dir):
    versions = _table_of(
        spark,
        table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
        ),
        "o_orderkey",
    )
    versions.update("o_totalprice > 100000", {"o_orderstatus": "BIG"})
    return versions.read()


@query("vt_delete", """
    SELECT event_id, nullif(event_type, 'error') AS event_type FROM events
    WHERE NOT coalesce(nullif(event_type, 'error') = 'view', false)""")
def vt_delete(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("event_type")
    )
    versions = _table_of(spark, events, "event_id")
    versions.delete("event_type = 'view'")
    return versions.read()


@query("vt_merge", """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'P'
    UNION ALL
    SELECT o_orderkey, 'X', round(o_totalprice * 2, 2) FROM orders WHERE o_orderstatus <> 'P'""")
def vt_merge(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    versions = _table_of(spark, orders.where("o_orderstatus <> 'O'"), "o_orderkey")
    versions.merge(
        orders.where("o_orderstatus <> 'P'").select(
            "o_orderkey", F.lit("X").alias("o_orderstatus"),
            F.round(F.col("o_totalprice") * 2, 2).alias("o_totalprice"),
        ),
        ["o_orderkey"],
    )
    return versions.read()


@query("vt_history", """
    WITH twice AS (
      SELECT s_acctbal, 0 AS since FROM supplier
      UNION ALL SELECT s_acctbal, 1 FROM supplier WHERE s_nationkey < 10)
    SELECT v.version, v.operation, count(*) AS n_rows
    FROM (VALUES (0::BIGINT, 'create'), (1::BIGINT, 'append'), (2::BIGINT, 'delete')) AS v(version, operation),
         twice
    WHERE since <= v.version AND (v.version <> 2 OR s_acctbal >= 0)
    GROUP BY ALL""")
def vt_history(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    versions = _table_of(spark, supplier)
    versions.append(supplier.where("s_nationkey < 10"))
    versions.delete("s_acctbal < 0")
    counts = versions.read(0).agg(F.count("*").alias("n_rows")).withColumn("version", F.lit(0))
    for v in (1, 2):
        counts = counts.union(
            versions.read(v).agg(F.count("*").alias("n_rows")).withColumn("version", F.lit(v))
        )
    return versions.history().join(counts, "version").select("version", "operation", "n_rows")


@query("vt_version_as_of", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def vt_version_as_of(spark, sf_dir):
    versions = _table_of(
        spark, table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    )
    versions.update("s_acctbal > 1000", {"s_acctbal": 0.0})
    versions.delete("s_acctbal = 0")
    return versions.read(0)


@query("vt_rollback", "SELECT s_suppkey, s_name, s_acctbal, 3::BIGINT AS version FROM supplier")
def vt_rollback(spark, sf_dir):
    versions = _table_of(
        spark, table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    )
    versions.update("s_acctbal > 1000", {"s_acctbal": 0.0})
    versions.delete("s_acctbal = 0")
    last = versions.rollback(0)
    return versions.read().withColumn("version", F.lit(last).cast("bigint"))


@query("ddl_create", "SELECT n_nationkey, n_name FROM nation")
def ddl_create(spark, sf_dir):
    database = scratch.work_database(spark)
    path = scratch.new_path(spark, "located")
    sinks.write_parquet(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), path)
    name = f"{database}.{scratch.new_name('nation')}"
    ddl.create_table(spark, name, location=path)
    return spark.table(name)


@query("ddl_rename", "SELECT r_regionkey, r_name FROM region")
def ddl_rename(spark, sf_dir):
    database = scratch.work_database(spark)
    old, new = (f"{database}.{scratch.new_name('region')}" for _ in range(2))
    sinks.save_table(table(spark, sf_dir, "region"), old)
    ddl.rename_table(spark, old, new)
    return spark.table(new)


@query("ddl_add_column", """
    SELECT c_custkey, c_nationkey, NULL::VARCHAR AS note FROM customer
    UNION ALL SELECT c_custkey, c_nationkey, c_mktsegment FROM customer""")
def ddl_add_column(spark, sf_dir):
    name = f"{scratch.work_database(spark)}.{scratch.new_name('customer')}"
    customer = table(spark, sf_dir, "customer")
    sinks.save_table(customer.select("c_custkey", "c_nationkey"), name)
    ddl.add_columns(spark, name, "note STRING")
    sinks.insert_into(customer.select("c_custkey", "c_nationkey", "c_mktsegment"), name)
    return spark.table(name)


_KEYED = """
    WITH c AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 > 0)"""


def _keyed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    target = KeyedTable(spark, scratch.new_path(spark, "keyed"), ["o_orderkey"])
    target.create(orders.where("o_orderkey % 10 > 0"), folders=64)
    return target, orders


@query("keyed_merge", _KEYED + """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM c WHERE o_orderkey % 997 > 0
    UNION ALL SELECT o_orderkey, 'M', o_totalprice FROM orders WHERE o_orderkey % 997 = 0""")
def keyed_merge(spark, sf_dir):
    """A thousandth of the orders comes anew, a tenth of them for the first time."""
    target, orders = _keyed(spark, sf_dir)
    target.merge(orders.where("o_orderkey % 997 = 0").withColumn("o_orderstatus", F.lit("M")))
    return target.read()


@query("keyed_update", _KEYED + """
    SELECT o_orderkey, CASE WHEN o_orderkey % 499 = 0 AND o_totalprice > 50000 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 499 = 0 AND o_totalprice > 50000 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
    FROM c""")
def keyed_update(spark, sf_dir):
    target, orders = _keyed(spark, sf_dir)
    target.update("o_totalprice > 50000", {"o_orderstatus": "U", "o_totalprice": -F.col("o_totalprice")}, keys=orders.where("o_orderkey % 499 = 0"))
    return target.read()


@query("keyed_delete", _KEYED + """
    SELECT * FROM c WHERE o_orderkey % 499 > 0 AND o_totalprice >= 1000""")
def keyed_delete(spark, sf_dir):
    target, orders = _keyed(spark, sf_dir)
    target.delete(keys=orders.where("o_orderkey % 499 = 0"))
    target.delete("o_totalprice < 1000")
    return target.read()

"""Sinks: each query writes a whole table and returns what a reader then sees."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators import ddl
from millrace.operators.versioned import VersionedTable
from millrace.queries.registry import query, table
from millrace.sources import files, sinks


@query("sink_csv", "SELECT doc_id, lang, source, n_chars, base64(encode(text)) AS body FROM documents")
def sink_csv(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.encode("text", "UTF-8").alias("body")
    )
    path = scratch.new_path(spark, "sink-csv")
    sinks.write_csv(docs, path)
    return files.read_csv(
        spark, path, schema="doc_id bigint, lang string, source string, n_chars bigint, body string",
        maxCharsPerColumn="-1",
    )


@query("sink_text", "SELECT CAST(o_orderkey AS VARCHAR) || ' ' || o_orderstatus AS value FROM orders")
def sink_text(spark, sf_dir):
    path = scratch.new_path(spark, "sink-text")
    sinks.write_lines(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), path)
    return files.read_lines(spark, path)


@query("sink_parquet", """
    SELECT o_orderstatus, 2 * count(*) AS n, round(2 * sum(o_totalprice), 2) AS total
    FROM orders GROUP BY o_orderstatus""")
def sink_parquet(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch.new_path(spark, "sink-parquet")
    sinks.write_parquet(orders.where("o_orderstatus = 'F'"), path)
    sinks.write_parquet(orders, path, mode="overwrite")
    sinks.write_parquet(orders, path, mode="append")
    return spark.read.schema(orders.schema).parquet(path).groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("sink_default", "SELECT p_partkey, p_name, p_retailprice FROM part")
def sink_default(spark, sf_dir):
    path = scratch.new_path(spark, "sink-default") + ".csv"
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    sinks.save_default(part, path, header="true")
    return spark.read.load(path)


@query("sink_table", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def sink_table(spark, sf_dir):
    name = f"{scratch.work_database(spark)}.{scratch.new_name('salary')}"
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    sinks.save_table(rows, name, fmt="csv")
    return spark.table(name)


@query("sink_ext_table", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def sink_ext_table(spark, sf_dir):
    name = f"{scratch.work_database(spark)}.{scratch.new_name('supplier')}"
    path = scratch.new_path(spark, "ext")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    sinks.save_table(rows, name, path=path, mode="overwrite")
    return spark.table(name)


@query("sink_versioned", """
    SELECT o_orderpriority, 2 * count(*) AS n FROM orders GROUP BY o_orderpriority""")
def sink_versioned(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    versions = VersionedTable(spark, scratch.new_path(spark, "vt"))
    versions.create(orders)
    versions.overwrite(orders)
    versions.append(orders)
    return versions.read().groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("insert_into", """
    SELECT c_mktsegment, 2 * count(*) AS n FROM customer GROUP BY c_mktsegment""")
def insert_into(spark, sf_dir):
    name = f"{scratch.work_database(spark)}.{scratch.new_name('customer')}"
    path = f"{sf_dir}/customer.parquet"
    ddl.create_table(spark, name, "c_custkey BIGINT, c_mktsegment STRING")
    for _ in range(2):
        spark.sql(f"INSERT INTO {name} SELECT c_custkey, c_mktsegment FROM parquet.`{path}`")
    return spark.table(name).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("insert_overwrite", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0")
def insert_overwrite(spark, sf_dir):
    name = f"{scratch.work_database(spark)}.{scratch.new_name('customer')}"
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    sinks.save_table(rows, name)
    spark.sql(
        f"INSERT OVERWRITE {name} SELECT c_custkey, c_mktsegment "
        f"FROM parquet.`{sf_dir}/customer.parquet` WHERE c_acctbal > 0"
    )
    return spark.table(name)


@query("partition_counts", "SELECT count(*) AS n_rows, 0::BIGINT AS torn_keys FROM lineitem")
def partition_counts(spark, sf_dir):
    """Rows over all partitions, and keys that lie in more than one."""
    dealt = table(spark, sf_dir, "lineitem").repartition("l_orderkey")
    torn = dealt.withColumn("part", F.spark_partition_id()).groupBy("l_orderkey").agg(
        F.count_distinct("part").alias("parts")).where("parts > 1").agg(F.count("*")).scalar()
    return sinks.partition_rows(dealt).agg(F.sum("n_rows").alias("n_rows")).select("n_rows", torn.alias("torn_keys"))


@query("limit_write", "SELECT least(count(*), 10000) AS n FROM lineitem")
def limit_write(spark, sf_dir):
    path = scratch.new_path(spark, "limit")
    sinks.write_first_rows(table(spark, sf_dir, "lineitem"), path, 10_000)
    return spark.read.parquet(path).agg(F.count("*").alias("n"))

"""Scans and sources.  Files are derived from the given tables by Spark first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators.versioned import VersionedTable
from millrace.queries.registry import query, table
from millrace.sources import files, sinks


def csv_of(spark: SparkSession, df: DataFrame, label: str, header: bool = True, **options) -> str:
    path = scratch.new_path(spark, label)
    sinks.write_csv(df, path, header=header, **options)
    return path


@query("scan_text", """
    SELECT line, count(*) AS n
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
    GROUP BY line""")
def scan_text(spark, sf_dir):
    path = scratch.new_path(spark, "text")
    sinks.write_lines(table(spark, sf_dir, "documents").select("text"), path)
    lines = files.read_lines(spark, path)
    return lines.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query("scan_csv_infer", """
    SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
           o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders""")
def scan_csv_infer(spark, sf_dir):
    path = csv_of(spark, table(spark, sf_dir, "orders"), "csv-infer")
    orders = files.read_csv(spark, path, infer=True)
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("scan_csv_dir", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_dir(spark, sf_dir):
    path = csv_of(spark, table(spark, sf_dir, "customer").repartition("c_custkey"), "csv-dir")
    return files.read_csv(
        spark, path,
        schema="c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    )


@query("scan_csv_strings", """
    SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
           CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal
    FROM supplier""")
def scan_csv_strings(spark, sf_dir):
    path = csv_of(spark, table(spark, sf_dir, "supplier"), "csv-strings")
    return files.read_csv(spark, path)


@query("scan_csv_delim", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def scan_csv_delim(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    path = csv_of(spark, part, "csv-delim", sep=";")
    return files.read_csv(spark, path, schema=part.schema, sep=";")


@query("scan_csv_schema", """
    SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty,
           round(sum(l_extendedprice), 2) AS sum_price, max(l_shipdate) AS last_ship
    FROM lineitem GROUP BY ALL""")
def scan_csv_schema(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    path = csv_of(spark, lineitem, "csv-schema", header=False)
    rows = files.read_csv(spark, path, header=False, schema=lineitem.schema)
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query("scan_csv_raw", """
    SELECT CAST(c_custkey AS VARCHAR) AS _c0, c_name AS _c1, CAST(c_nationkey AS VARCHAR) AS _c2,
           CAST(c_acctbal AS VARCHAR) AS _c3, c_mktsegment AS _c4 FROM customer""")
def scan_csv_raw(spark, sf_dir):
    path = csv_of(spark, table(spark, sf_dir, "customer"), "csv-raw", header=False)
    return files.read_csv(spark, path, header=False)


@query("scan_parquet", """
    SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_quantity > 45""")
def scan_parquet(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where(
        "l_shipdate >= TIMESTAMP_NTZ '1997-01-01' AND l_quantity > 45"
    ).select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")


@query("scan_file_counts", "SELECT 'lineitem.parquet' AS file_name, count(*) AS n_rows FROM lineitem")
def scan_file_counts(spark, sf_dir):
    return files.rows_per_file(table(spark, sf_dir, "lineitem"))


def _draw(cells: DataFrame, folder: str) -> DataFrame:
    """One 50 x 50 gray PNG per name from its at most 2,500 (name, x, y, shade) cells."""

    def draw(pdf):
        import struct
        import zlib

        import numpy as np
        import pandas as pd
        from pyarrow import fs

        def chunk(kind, body):
            return (struct.pack(">I", len(body)) + kind + body
                    + struct.pack(">I", zlib.crc32(kind + body)))

        pixels = np.zeros((50, 51), dtype=np.uint8)     # column 0: no line filter
        pixels[pdf["y"], pdf["x"] + 1] = pdf["shade"]
        picture = (
            b"\x89PNG\r\n\x1a\n"
            + chunk(b"IHDR", struct.pack(">IIBBBBB", 50, 50, 8, 0, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(pixels.tobytes())) + chunk(b"IEND", b"")
        )
        uri = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
        store, path = fs.FileSystem.from_uri(uri)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/{pdf['name'].iloc[0]}.png") as out:
            out.write(picture)
        return pd.DataFrame({"name": [pdf["name"].iloc[0]], "size": [len(picture)]})

    return cells.groupBy("name").applyInPandas(draw, "name string, size long")


@query("scan_image", """
    WITH c AS (
      SELECT l_returnflag AS name, CAST(l_quantity AS INTEGER) - 1 AS x,
             CAST(least(floor(l_extendedprice / 2200), 49) AS INTEGER) AS y, count(*) AS n
      FROM lineitem GROUP BY ALL),
    g AS (SELECT name, x, y FROM (SELECT DISTINCT name FROM c),
            (SELECT unnest(range(50)) AS x), (SELECT unnest(range(50)) AS y))
    SELECT name, 50 AS height, 50 AS width, 1 AS channels,
           string_agg(printf('%02X', CAST(least(coalesce(n, 0), 255) AS INTEGER)), '' ORDER BY y, x) AS pixels
    FROM g LEFT JOIN c USING (name, x, y) GROUP BY name""")
def scan_image(spark, sf_dir):
    cells = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("name"),
        (F.col("l_quantity").cast("int") - 1).alias("x"),
        F.least(F.floor(F.col("l_extendedprice") / 2200), F.lit(49)).cast("int").alias("y"),
    ).agg(F.least(F.count("*"), F.lit(255)).cast("int").alias("shade"))
    folder = scratch.new_path(spark, "images")
    _draw(cells, folder).write.format("noop").mode("overwrite").save()
    return files.read_images(spark, folder).select(
        F.regexp_extract("image.origin", r"([^/]+)\.png$", 1).alias("name"),
        "image.height", "image.width", F.col("image.nChannels").alias("channels"),
        F.hex("image.data").alias("pixels"),
    )


@query("scan_json", """
    SELECT event_id, event_type, props, ts, user_id, value FROM events""")
def scan_json(spark, sf_dir):
    path = scratch.new_path(spark, "json")
    sinks.write_json(table(spark, sf_dir, "events"), path)
    return files.read_json(spark, path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("scan_sql_view_csv", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def scan_sql_view_csv(spark, sf_dir):
    nation = scratch.new_name("nation")
    region = scratch.new_name("region")
    files.file_view(
        spark, nation, csv_of(spark, table(spark, sf_dir, "nation"), "view-nation"),
        columns="n_nationkey INT, n_name STRING, n_regionkey INT", header="true",
    )
    files.file_view(
        spark, region, csv_of(spark, table(spark, sf_dir, "region"), "view-region"),
        header="true", inferSchema="true",
    )
    return spark.sql(
        f"SELECT n_nationkey, n_name, r_name FROM {nation} JOIN {region} "
        "ON n_regionkey = r_regionkey"
    )


@query("scan_path_table", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def scan_path_table(spark, sf_dir):
    orders = files.path_as_table(spark, f"{sf_dir}/orders.parquet")
    return orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("scan_table", "SELECT p_brand, count(*) AS n, max(p_size) AS max_size FROM part GROUP BY p_brand")
def scan_table(spark, sf_dir):
    name = f"{scratch.work_database(spark)}.{scratch.new_name('part')}"
    sinks.save_table(table(spark, sf_dir, "part"), name)
    return spark.table(name).groupBy("p_brand").agg(
        F.count("*").alias("n"), F.max("p_size").alias("max_size")
    )


@query("scan_versioned", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_versioned(spark, sf_dir):
    versions = VersionedTable(spark, scratch.new_path(spark, "vt"))
    versions.create(table(spark, sf_dir, "supplier"))
    return versions.read()


@query("scan_literals", """
    SELECT meaning, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty
    FROM lineitem JOIN (VALUES ('R', 'returned'), ('A', 'accepted'), ('N', 'none')) AS v(flag, meaning)
      ON l_returnflag = flag
    GROUP BY meaning""")
def scan_literals(spark, sf_dir):
    # Three literal rows: the broadcast side is fixed by this text.
    flags = spark.createDataFrame(
        [("R", "returned"), ("A", "accepted"), ("N", "none")], "flag string, meaning string"
    )
    per_flag = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("sum_qty")
    )
    return per_flag.join(F.broadcast(flags), F.col("l_returnflag") == F.col("flag")).select(
        "meaning", "n", "sum_qty"
    )


@query("scan_range", """
    SELECT id, coalesce(n, 0) AS n
    FROM (SELECT unnest(range(60)) AS id)
    LEFT JOIN (SELECT CAST(l_quantity AS BIGINT) AS qty, count(*) AS n FROM lineitem GROUP BY 1)
      ON id = qty""")
def scan_range(spark, sf_dir):
    per_quantity = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_quantity").cast("bigint").alias("qty"))
        .agg(F.count("*").alias("n"))
    )
    ids = spark.range(60)
    return ids.join(per_quantity, ids["id"] == per_quantity["qty"], "left").select(
        "id", F.coalesce("n", F.lit(0)).alias("n")
    )

"""Sources and sinks: round trips and options."""

from __future__ import annotations

import os
import struct
import zlib

import pytest
from tests.conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators import ddl
from millrace.plans import cleanse
from millrace.sources import files, jdbc, sinks, topics


def _png(path: str, width: int, height: int) -> None:
    def chunk(kind: bytes, body: bytes) -> bytes:
        return (struct.pack(">I", len(body)) + kind + body
                + struct.pack(">I", zlib.crc32(kind + body)))

    lines = b"".join(b"\0" + b"\x80" * width for _ in range(height))
    with open(path, "wb") as out:
        out.write(
            b"\x89PNG\r\n\x1a\n"
            + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")
        )


def test_images(spark, tmp_path):
    _png(str(tmp_path / "a.png"), 4, 2)
    _png(str(tmp_path / "b.png"), 4, 3)
    _png(str(tmp_path / "c.png"), 1, 1)
    images = files.read_images(spark, str(tmp_path)).select("image.*")
    assert images.columns == ["origin", "height", "width", "nChannels", "mode", "data"]
    from millrace.operators.filters import at_global_max

    widest = at_global_max(images.select("width", "height"), "width")
    assert rows(widest) == [(4, 2), (4, 3)]


def test_binary_survives_csv(spark, folder):
    df = spark.createDataFrame([(1, bytearray(b"\x00\xff" * 100))], "id int, data binary")
    sinks.write_csv(df, folder)
    back = files.read_csv(spark, folder, schema="id int, data string")
    assert back.select(F.unbase64("data").alias("d")).first()["d"] == b"\x00\xff" * 100


def test_csv_quotes_nulls_and_microseconds(spark, folder):
    df = spark.sql(
        "SELECT 'a,\"b\"' AS s, CAST(NULL AS INT) AS n, "
        "TIMESTAMP_NTZ '2024-01-02 03:04:05.678901' AS t"
    )
    sinks.write_csv(df, folder, escape='"')
    assert rows(files.read_csv(spark, folder, schema=df.schema, escape='"')) == rows(df)


def test_country_file_with_quoted_delimiter(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text(
        "OFFICIAL LANG CODE;ISO2 CODE;ISO3 CODE;LABEL EN;Geo Shape;ONU CODE;LABEL FR\n"
        'EN;GB;GBR;United Kingdom;"a;b";1;Royaume-Uni\n'
    )
    codes = cleanse.country_codes(files.read_csv(spark, str(path), sep=";"))
    assert codes.columns == ["CountryCode", "ISO2Code", "ISO3Code", "CountryName", "GeoShape"]
    assert rows(codes) == [("EN", "GB", "GBR", "United Kingdom", "a;b")]


def test_csv_inference_and_raw_names(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2.5\n2,x\n")
    typed = files.read_csv(spark, str(tmp_path), infer=True)
    assert typed.dtypes == [("a", "int"), ("b", "string")]
    raw = files.read_csv(spark, str(tmp_path), header=False)
    assert raw.columns == ["_c0", "_c1"] and raw.count() == 3


def test_first_field_of_each_line(spark, tmp_path):
    (tmp_path / "t.txt").write_text("one two\n\n three\none\n")
    view = scratch.new_name("words")
    files.file_view(spark, view, str(tmp_path), columns="word STRING", delimiter=" ")
    got = spark.sql(f"SELECT word, count(word) AS n FROM {view} GROUP BY word")
    assert rows(got) == [("one", 2), (None, 0)]


def test_parquet_modes(spark, folder):
    df = spark.range(5)
    sinks.write_parquet(df, folder)
    with pytest.raises(AnalysisException):
        sinks.write_parquet(df, folder)
    sinks.write_parquet(df, folder, mode="append")
    assert spark.read.parquet(folder).count() == 10
    sinks.write_parquet(df, folder, mode="overwrite", files=1)
    assert spark.read.parquet(folder).count() == 5
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) == 1


def test_default_format_is_parquet(spark, folder):
    df = spark.createDataFrame([("Python", 1), ("Spark", 2)], "word string, count bigint")
    sinks.save_default(df, folder + ".csv", header="true")
    assert rows(spark.read.parquet(folder + ".csv")) == rows(df)


def test_first_rows(spark, folder):
    df = spark.range(0, 100, 1, 8)
    sinks.write_first_rows(df, folder, 30)
    assert rows(spark.read.parquet(folder)) == rows(spark.range(30))
    sinks.write_first_rows(df, folder, 0, mode="overwrite")
    assert spark.read.parquet(folder).count() == 0
    sinks.write_first_rows(df, folder, 1_000, mode="overwrite")
    assert spark.read.parquet(folder).count() == 100


def test_partition_and_file_rows(spark, folder):
    df = spark.range(100).repartition(4)
    assert sinks.partition_rows(df).agg(F.sum("n_rows")).first()[0] == 100
    sinks.write_parquet(df, folder)
    per_file = files.rows_per_file(spark.read.parquet(folder))
    assert per_file.count() == 4
    assert per_file.agg(F.sum("n_rows")).first()[0] == 100


def test_jdbc_options_and_statement():
    options = jdbc.jdbc_options("jdbc:x://h/db", "authors", driver="d.D", user="u", password="p'w")
    assert options == {"url": "jdbc:x://h/db", "dbtable": "authors", "driver": "d.D",
                       "user": "u", "password": "p'w"}
    assert jdbc.jdbc_view_sql("v", jdbc.jdbc_options("jdbc:x://h/db", "authors")) == (
        "CREATE OR REPLACE TEMPORARY VIEW v USING org.apache.spark.sql.jdbc "
        "OPTIONS (url 'jdbc:x://h/db', dbtable 'authors')"
    )


def test_split_jdbc_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, jdbc.jdbc_options("jdbc:x://h/db", "t"), split_column="id")


def test_topic_messages_round_trip(spark):
    df = spark.sql(
        "SELECT 7 AS id, 'x' AS name, TIMESTAMP_NTZ '2024-01-01 10:00:00' AS at"
    )
    messages = topics.encode(df, "id", ["id", "name"], time="at")
    assert messages.columns == ["key", "value", "timestamp"]
    back = topics.decode(messages, "id int, name string")
    assert back.columns == ["id", "name", "EventTime"]
    assert back.first()["name"] == "x"
    bad = messages.withColumn("value", F.lit("{"))
    assert topics.decode(bad, "id int, name string").first()["id"] is None


def test_ddl(spark):
    database = scratch.work_database(spark)
    short = scratch.new_name("t")
    name = f"{database}.{short}"
    ddl.create_table(spark, name, "id BIGINT, s STRING")
    sinks.insert_into(spark.sql("SELECT 1L AS id, 'a' AS s"), name)
    assert short in [r["tableName"] for r in ddl.tables_of(spark, database).collect()]
    spark.sql("USE default")
    ddl.truncate_table(spark, name)
    assert spark.table(name).count() == 0
    ddl.drop_table(spark, name)
    ddl.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
    other = scratch.new_name("db")
    ddl.create_database(spark, other, scratch.new_path(spark, "db"))
    ddl.drop_database(spark, other, cascade=True)
    assert not spark.catalog.databaseExists(other)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace as Fake

    from millrace import scratch

    def session(master, folder):
        kept = {scratch.SETTING: folder} if folder else {}
        return Fake(conf=Fake(get=lambda k, d: kept.get(k, d)), sparkContext=Fake(master=master, applicationId="fake"))

    for master in ("yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"):
        with pytest.raises(scratch.NoSharedFolder):
            scratch.shared_root(session(master, None))
        assert scratch.shared_root(session(master, "hdfs:///shared/")) == "hdfs:///shared"
    for master in ("local", "local[4]", "local[*]"):
        assert scratch.shared_root(session(master, None))


def test_scratch_without_the_setting_in_a_real_session(tmp_path):
    """A session of its own, whose defaults name no folder."""
    import os
    import pathlib
    import subprocess
    import sys

    code = (
        "from pyspark.sql import SparkSession\n"
        "from millrace import scratch\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert s.conf.get(scratch.SETTING, None) is None, s.conf.get(scratch.SETTING)\n"
        "assert scratch.shared_root(s) == scratch.shared_root(s)\n"
        "assert scratch.keep(s.range(5)).count() == 5\n")
    (tmp_path / "spark-defaults.conf").write_text("")
    done = subprocess.run([sys.executable, "-c", code], cwd=pathlib.Path(__file__).parents[1], timeout=300, capture_output=True, text=True,
                          env=os.environ | {"SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path)})
    assert done.returncode == 0, done.stderr[-2000:]

"""Streams equal batches; restarts add nothing; late rows drop."""

from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.conftest import ROOT, rows

from millrace import scratch
from millrace.operators.versioned import VersionedTable
from millrace.plans.multi_hop import HopPaths, run_hops
from millrace.sources import files
from millrace.streaming import changes, runs, tables
from millrace.streaming.changes import apply_changes
from millrace.streaming.windows import sliding_activity

SCHEMA = "id int, at timestamp, kind string"


def _at(second: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)


def _events(spark, seconds, kind="a"):
    return spark.createDataFrame([(i, _at(s), kind) for i, s in enumerate(seconds)], SCHEMA)


def _stream(spark, folder, **options):
    return spark.readStream.schema(SCHEMA).options(**options).parquet(folder)


def _activity(df, delay="1 minute"):
    return sliding_activity(df, "at", "kind", delay=delay)


def test_a_row_lies_in_three_half_open_windows(spark):
    got = rows(_activity(_events(spark, [20]), None).select("window_start", "window_end", "n"))
    assert got == [(_at(s), _at(s + 30), 1) for s in (0, 10, 20)]
    # 30 seconds after the start is outside
    edge = _activity(_events(spark, [30]), None)
    assert edge.where(F.col("window_start") == _at(0).isoformat(" ")).count() == 0


def test_count_skips_null_keys_but_groups_them(spark):
    df = spark.createDataFrame([(1, _at(5), None)], SCHEMA)
    assert {r["n"] for r in _activity(df, None).collect()} == {0}


@pytest.mark.parametrize("parts", [1, 3, 10])
def test_append_emits_the_closed_windows(spark, folder, parts):
    seconds = list(range(0, 600, 7))
    events = _events(spark, seconds)
    for i in range(parts):      # files in time order, one micro-batch each
        low, high = i * 600 / parts, (i + 1) * 600 / parts
        part = events.where(
            (F.unix_timestamp("at") - F.unix_timestamp(F.lit(_at(0))) >= low)
            & (F.unix_timestamp("at") - F.unix_timestamp(F.lit(_at(0))) < high)
        )
        part.coalesce(1).write.mode("append").parquet(folder)
    out = scratch.new_path(spark, "out")
    stream = _activity(_stream(spark, folder, maxFilesPerTrigger=1))
    runs.to_parquet(stream, out, runs.new_checkpoint(stream))
    last = max(seconds)
    batch = _activity(events, None).where(
        F.col("window_end") <= F.lit(_at(last - 60))
    )
    assert rows(spark.read.parquet(out)) == rows(batch)


def test_complete_mode_equals_batch(spark, folder):
    events = _events(spark, range(0, 300, 11))
    events.repartition(3).write.parquet(folder)
    name = scratch.new_name("board")
    runs.to_memory(_activity(_stream(spark, folder, maxFilesPerTrigger=1)), name)
    assert rows(spark.table(name)) == rows(_activity(events, None))


def test_late_rows_drop_and_restart_adds_nothing(spark, folder):
    out, checkpoint = scratch.new_path(spark, "out"), scratch.new_path(spark, "ck")

    def go():
        runs.to_parquet(_activity(_stream(spark, folder)), out, checkpoint)
        return rows(spark.read.parquet(out))

    _events(spark, [0, 5, 400]).coalesce(1).write.parquet(folder)
    first = go()
    assert go() == first
    _events(spark, [1, 800]).coalesce(1).write.mode("append").parquet(folder)
    second = go()
    # the row at second 1 is older than 400 - 60 and changes no emitted window
    assert first == [r for r in second if r[0] < _at(300)]
    assert any(r[0] >= _at(380) for r in second)


def test_plain_stream_restart(spark, folder):
    out, checkpoint = scratch.new_path(spark, "out"), scratch.new_path(spark, "ck")
    spark.range(10).selectExpr("CAST(id AS INT) AS id").write.parquet(folder)
    for want in (10, 10):
        stream = spark.readStream.schema("id int").parquet(folder)
        runs.to_parquet(stream, out, checkpoint)
        assert spark.read.parquet(out).count() == want
    spark.range(5).selectExpr("CAST(id AS INT) AS id").write.mode("append").parquet(folder)
    runs.to_parquet(spark.readStream.schema("id int").parquet(folder), out, checkpoint)
    assert spark.read.parquet(out).count() == 15


def test_files_per_trigger(spark, folder):
    spark.range(30).repartition(3).write.parquet(folder)
    seen = []
    stream = files.stream_table(spark, folder, files_per_trigger=1)
    runs.to_batches(stream, lambda batch, i: seen.append((i, batch.count())),
                    runs.new_checkpoint(stream))
    assert [i for i, _ in seen] == [0, 1, 2] and sum(n for _, n in seen) == 30


def test_batch_rows_and_streamed_rows_share_a_table(spark, folder):
    target = VersionedTable(spark, scratch.new_path(spark, "vt"))
    target.create(_events(spark, [1, 2, 3]))
    _events(spark, range(5)).repartition(2).write.parquet(folder)
    checkpoint = scratch.new_path(spark, "ck")
    for _ in range(2):
        tables.append_stream(_stream(spark, folder, maxFilesPerTrigger=1), target, checkpoint)
    assert target.read().count() == 8
    # a second stream counts its batches from 0 again and still adds its rows
    other = scratch.new_path(spark, "other")
    _events(spark, range(4)).coalesce(1).write.parquet(other)
    for _ in range(2):
        tables.append_stream(_stream(spark, other), target, checkpoint + "-other")
    assert target.read().count() == 12


def test_micro_batches_run_on_until_stopped(spark, folder):
    target = VersionedTable(spark, scratch.new_path(spark, "vt"))
    target.create(_events(spark, [1]))
    _events(spark, range(3)).coalesce(1).write.parquet(folder)
    running = tables.append_stream(
        _stream(spark, folder), target, scratch.new_path(spark, "ck"), once=False, every="100 milliseconds"
    )
    try:
        running.processAllAvailable()
        assert running.isActive and target.read().count() == 4
        _events(spark, range(2)).coalesce(1).write.mode("append").parquet(folder)
        running.processAllAvailable()
        assert target.read().count() == 6
    finally:
        running.stop()


def test_upserts_keep_the_last_row_per_key(spark, folder):
    target = VersionedTable(spark, scratch.new_path(spark, "vt"))
    target.create(spark.createDataFrame([(1, _at(0), "old"), (9, _at(0), "old")], SCHEMA))
    changes = [(1, _at(5), "b"), (1, _at(9), "c"), (2, _at(1), "d")]
    spark.createDataFrame(changes, SCHEMA).coalesce(1).write.parquet(folder)
    checkpoint = scratch.new_path(spark, "ck")

    def go():
        tables.upsert_stream(_stream(spark, folder), target, ["id"], ["at"], checkpoint)
        return rows(target.read().select("id", "kind"))

    want = [(1, "c"), (2, "d"), (9, "old")]
    assert go() == want and go() == want
    assert target.current_version() == 1


def test_hops_keep_bad_times_out_of_the_windows(spark, folder):
    lines = [("a", "01/1/24 00:00"), ("a", "1/1/24 0:00"), ("a", "01/1/24 00:10")]
    spark.createDataFrame(lines, "kind string, time string").coalesce(1).write.option(
        "header", True).csv(folder)
    raw = files.stream_csv(spark, folder, "kind string, time string")
    paths = HopPaths(scratch.new_path(spark, "hops"))
    got = run_hops(spark, raw, paths, "time", "kind", size="2 minutes", slide="1 minute")
    assert rows(got.select("window_end", "n")) == [(_at(60), 1), (_at(120), 1)]
    assert spark.read.parquet(paths.table("parsed")).count() == 3


CHANGES = "key string, at timestamp, place int, value string"


def _changes(n=60):
    return [(f"k{i % 7}" if i % 13 else None, _at(i * 10 // 3), i, f"v{i}") for i in range(n)]


def _arrive(spark, folder, batches):
    for batch in batches:
        spark.createDataFrame(batch, CHANGES).coalesce(1).write.mode("append").parquet(folder)


def _apply(spark, folder, target, checkpoint, delay=None):
    stream = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(folder)
    apply_changes(stream, target, ["key"], ["at", "place"], checkpoint, delay=delay)


@pytest.mark.parametrize("delay", [None, "1 hour"])
def test_shuffled_batches_give_the_table_of_one_batch(spark, folder, delay):
    changes = _changes()
    newest = {}
    for c in changes:
        if c[0] is not None:
            newest[c[0]] = max(newest.get(c[0], c), c, key=lambda c: (c[1], c[2]))
    shuffled = sorted(changes, key=lambda c: (c[2] * 37) % 61)
    target = VersionedTable(spark, f"{folder}/table", keys=["key"])
    target.create(spark.createDataFrame([("k1", _at(0), -1, "old"), ("other", _at(0), -1, "old")], CHANGES))
    checkpoint = f"{folder}/checkpoint"
    _arrive(spark, f"{folder}/in", [shuffled[i::3] for i in range(2)])
    _apply(spark, f"{folder}/in", target, checkpoint, delay)
    _arrive(spark, f"{folder}/in", [shuffled[2::3], [(None, None, 3, "no place"), ("k2", None, 999, "no place")]])
    _apply(spark, f"{folder}/in", target, checkpoint, delay)       # restarted
    got = target.read().where("key IS NOT NULL")
    assert rows(got) == sorted([*newest.values(), ("other", _at(0), -1, "old")])


def test_late_changes_need_no_setting_of_the_session(spark, folder):
    """A session with Spark's default state store; it has the same one afterwards."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    own, plain = spark.conf.get(setting), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    target = VersionedTable(spark, f"{folder}/table", keys=["key"])
    target.create(spark.createDataFrame([], CHANGES))
    _arrive(spark, f"{folder}/in", [[("a", _at(9), 1, "new")], [("a", _at(5), 2, "late")]])
    spark.conf.set(setting, plain)
    try:
        _apply(spark, f"{folder}/in", target, f"{folder}/checkpoint")
        assert spark.conf.get(setting) == plain
    finally:
        spark.conf.set(setting, own)
    assert [r.value for r in target.read().collect()] == ["new"]


def test_state_is_sent_to_processes_without_this_library(tmp_path):
    processor = changes._newest_only(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("p", T.IntegerType())]), ["p"], False)
    (tmp_path / "it").write_bytes(cloudpickle.dumps(processor))
    code = f"import sys; sys.path[:] = [p for p in sys.path if p != {str(ROOT)!r}]\nfrom pyspark import cloudpickle\nprint(cloudpickle.loads(open('it', 'rb').read()).places)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
    assert done.stdout == "('p',)\n", done.stderr


def test_forgotten_places_lose_nothing(spark, folder):
    """The state holds only keys of the last ten seconds; changes within that are placed right."""
    first = [("a", _at(100), 1, "a1"), ("b", _at(101), 2, "b2")]
    later = [("c", _at(300), 3, "c3")]
    back = [("c", _at(295), 4, "c4"), ("a", _at(301), 5, "a5"), ("b", _at(50), 6, "too late")]
    target = VersionedTable(spark, f"{folder}/table")
    target.create(spark.createDataFrame([], CHANGES))
    _arrive(spark, f"{folder}/in", [first, later, back, [("d", _at(302), 7, "d7")]])
    checkpoint = f"{folder}/checkpoint"
    _apply(spark, f"{folder}/in", target, checkpoint, delay="10 seconds")
    assert {(r.key, r.value) for r in target.read().collect()} == {("a", "a5"), ("b", "b2"), ("c", "c3"), ("d", "d7")}
    state = spark.read.format("statestore").option("stateVarName", "newest").load(checkpoint)
    assert {r.key.key for r in state.collect()} == {"a", "c", "d"}


def test_state_is_the_complete_result(spark, folder):
    events = _events(spark, range(0, 50)).union(_events(spark, range(50, 70), kind="b"))
    events.repartition(4).write.parquet(f"{folder}/in")
    stream = _stream(spark, f"{folder}/in", maxFilesPerTrigger=1)
    totals = stream.groupBy("kind", F.col("id") % 2).agg(F.count("*").alias("n"), F.max("at").alias("last"), F.max("id").alias("most"), F.avg("id").alias("m"))
    runs.to_state(totals, f"{folder}/checkpoint")
    got = runs.state_rows(spark, f"{folder}/checkpoint", ["n", "last", "most", "total", "seen"])
    want = events.groupBy("kind", F.col("id") % 2).agg(F.count("*"), F.max("at"), F.max("id"), F.sum(F.col("id").cast("double")), F.count("id"))
    assert rows(got) == rows(want)
    assert 0 < runs.state_rows(spark, f"{folder}/checkpoint", ["n", "last", "most", "total", "seen"], batch=0).agg(F.sum("n")).first()[0] < 70
    with pytest.raises(ValueError):
        runs.state_rows(spark, f"{folder}/checkpoint", ["n"])

"""Table laws: atomic versions, enforcement, merge, time travel, rollback."""

from __future__ import annotations

import os

import pytest
from tests.conftest import rows
from pyspark.sql import functions as F

from millrace.operators.versioned import DuplicateSourceKeys, SchemaMismatch, VersionedTable


@pytest.fixture
def vt(spark, folder):
    table = VersionedTable(spark, folder)
    table.create(spark.range(5).withColumn("customer_id", F.lit(2)))
    return table


def test_update_delete_rollback(vt):
    vt.update("id > 2", {"customer_id": 9})
    assert [r[1] for r in rows(vt.read())] == [2, 2, 2, 9, 9]
    vt.delete("id = 4")
    assert vt.read().count() == 4
    assert vt.rollback(0) == 3
    assert rows(vt.read()) == rows(vt.read(0)) == [(i, 2) for i in range(5)]
    assert vt.read(2).count() == 4
    assert [tuple(r) for r in vt.history().orderBy("version").select("version", "operation").collect()] == [
        (0, "create"), (1, "update"), (2, "delete"), (3, "rollback")]


def test_null_condition_changes_nothing(spark, folder):
    table = VersionedTable(spark, folder)
    table.create(spark.createDataFrame([(1, None), (2, "x")], "id int, s string"))
    table.update("s = 'x'", {"id": 5})
    assert rows(table.read()) == [(1, None), (5, "x")]
    table.delete("s = 'x'")
    assert rows(table.read()) == [(1, None)]
    table.delete("id = 1")
    assert table.read().count() == 0
    table.append(spark.createDataFrame([(9, "z")], "id int, s string"))
    assert rows(table.read()) == [(9, "z")]


def test_other_types_are_refused(vt, spark):
    before = rows(vt.read())
    wrong_type = spark.range(2).withColumn("customer_id", F.lit("a"))
    extra = spark.range(2).withColumns({"customer_id": F.lit(1), "more": F.lit(1)})
    for bad in (wrong_type, extra, spark.range(2)):
        with pytest.raises(SchemaMismatch):
            vt.append(bad)
    assert vt.current_version() == 0 and rows(vt.read()) == before


def test_new_column_needs_merge_schema(vt, spark):
    vt.append(
        spark.range(1).withColumns({"customer_id": F.lit(1), "more": F.lit("m")}),
        merge_schema=True,
    )
    assert rows(vt.read().where("more is null"))[0] == (0, 2, None)
    assert rows(vt.read().where("more is not null")) == [(0, 1, "m")]
    with pytest.raises(SchemaMismatch):
        vt.append(spark.range(1).withColumns({"customer_id": F.lit("t")}), merge_schema=True)


def test_changes_rewrite_only_touched_segments(vt, spark):
    vt.append(spark.range(100, 105).withColumn("customer_id", F.lit(3)))
    before = set(vt.history().where("version = 1").first()["segments"])
    vt.delete("id = 102")
    after = set(vt.history().where("version = 2").first()["segments"])
    assert len(before & after) == 1 and vt.read().count() == 9
    vt.delete("id = 77777")
    assert set(vt.history().where("version = 3").first()["segments"]) == after


def test_a_change_of_one_key_leaves_other_folders_alone(spark, folder):
    table = VersionedTable(spark, folder, keys=["id"], folders=8)
    table.create(spark.range(1000).withColumn("v", F.lit(1)).repartition(3))

    def segments():
        return set(table.history().orderBy(F.desc("version")).first()["segments"])

    first = segments()
    assert len(first) == 8
    one = spark.createDataFrame([(77, 5)], "id bigint, v int")
    for change in (lambda: table.merge(one, ["id"]), lambda: table.update("id = 77", {"v": 6}), lambda: table.delete("id = 78")):
        before = segments()
        change()
        assert len(before & segments()) == 7 and len(segments()) == 8
    assert table.read().count() == 999 and table.read().where("v = 6").count() == 1
    before = segments()
    table.merge(spark.createDataFrame([(5000, 1)], "id bigint, v int"), ["id"])
    assert before < segments() and table.read().count() == 1000
    table.delete("id >= 0")
    assert table.read().count() == 0 and VersionedTable(spark, folder).read(0).count() == 1000


def test_merge_replaces_inserts_and_is_idempotent(vt, spark):
    source = spark.createDataFrame([(3, 30), (7, 70), (None, 1)], "id bigint, customer_id int")
    vt.merge(source, ["id"])
    want = [(0, 2), (1, 2), (2, 2), (3, 30), (4, 2), (7, 70), (None, 1)]
    assert rows(vt.read()) == want
    vt.merge(source.where("id is not null"), ["id"])
    assert rows(vt.read()) == want
    vt.merge(source.where("id is null"), ["id"])        # null keys match nothing
    assert vt.read().count() == len(want) + 1


def test_merge_refuses_a_key_twice(vt, spark):
    twice = spark.createDataFrame([(3, 30), (3, 31)], "id bigint, customer_id int")
    with pytest.raises(DuplicateSourceKeys):
        vt.merge(twice, ["id"])
    assert vt.current_version() == 0


def test_merge_on_a_hot_target_key(spark, folder):
    table = VersionedTable(spark, folder)
    table.create(spark.range(900).select((F.col("id") % 3).alias("k"), F.lit(1).alias("v")))
    table.merge(spark.createDataFrame([(0, 5)], "k bigint, v int"), ["k"])
    assert rows(table.read().groupBy("k").count()) == [(0, 1), (1, 300), (2, 300)]


def test_a_batch_id_is_applied_once(vt, spark):
    more = spark.range(5, 6).withColumn("customer_id", F.lit(1))
    for _ in range(2):
        vt.append(more, source="s", batch_id=0)
    vt.append(more, source="s", batch_id=1)
    assert vt.read().count() == 7


def test_half_written_version_is_invisible(vt, spark):
    spark.range(3).write.parquet(f"{vt.path}/segments/orphan")
    os.makedirs(f"{vt.path}/history/version=1/_temporary/0")
    assert vt.read().count() == 5 and vt.current_version() == 0


def test_unknown_version(vt):
    with pytest.raises(ValueError):
        vt.read(12)

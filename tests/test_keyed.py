"""Tables in folders by key: changes touch few files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from millrace.operators import keyed
from millrace.operators.joins import plan_bytes
from millrace.operators.keyed import KeyedTable


def made(spark, folder, rows, folders):
    table = KeyedTable(spark, folder, ["k"])
    table.create(spark.range(rows).select(F.col("id").alias("k"), F.lit("old").alias("v")), folders=folders)
    return table


def test_a_hundred_keys_rewrite_at_most_a_hundred_folders(spark, folder):
    target = made(spark, folder, 5000, 1000)
    before = {tuple(r) for r in target.files().collect()}
    assert len(before) > 900
    changes = spark.range(0, 5000, 50).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    assert target.merge(changes) <= 100
    after = {tuple(r) for r in target.files().collect()}
    assert len(after) == len(before) and len(after - before) <= 100
    assert rows(target.read().groupBy("v").count()) == [("new", 100), ("old", 4900)]


def test_update_and_delete_touch_the_folders_of_their_keys(spark, folder):
    target = made(spark, folder, 300, 100)
    few = spark.range(20).toDF("k")
    before = {tuple(r) for r in target.files().collect()}
    assert target.update("k % 2 = 0", {"v": F.concat("v", F.lit("!"))}, keys=few) <= 10
    assert target.delete("k < 3 OR NULL", keys=few) <= 3
    after = {tuple(r) for r in target.files().collect()}
    assert len(after - before) <= 13
    assert rows(target.read().where("k < 6")) == [(3, "old"), (4, "old!"), (5, "old")]
    assert target.read().count() == 297
    assert target.delete("k >= 10") > 80
    assert sorted(r["k"] for r in target.read().collect()) == list(range(3, 10))
    assert target.delete() and target.read().count() == 0 and KeyedTable(spark, folder, ["k"]).read().columns == ["k", "v"]
    assert target.merge(few.withColumn("v", F.lit("again"))) <= 20 and target.read().count() == 20


def test_null_and_repeated_keys(spark, folder):
    table = KeyedTable(spark, folder, ["a", "b"])
    table.create(spark.createDataFrame([(1, "x", 1), (None, "x", 2), (1, None, 3)], "a int, b string, v int"), folders=4)
    table.merge(spark.createDataFrame([(1, "x", 10), (None, "x", 20)], "a int, b string, v int"))
    assert rows(table.read()) == [(1, "x", 10), (1, None, 3), (None, "x", 2), (None, "x", 20)]
    with pytest.raises(keyed.RepeatedKeys):
        table.merge(spark.createDataFrame([(1, "x", 1), (1, "x", 2)], "a int, b string, v int"))
    with pytest.raises(ValueError):
        table.update("true", {"a": 5})
    assert table.update("v > 5", {"v": 0}, keys=spark.createDataFrame([(1, "x"), (None, "x")], "a int, b string")) == 1
    assert rows(table.read().select("v")) == [(0,), (2,), (20,), (3,)]


def test_folders_follow_the_bytes(spark, folder, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    table = KeyedTable(spark, folder, ["o_orderkey"])
    table.create(orders)
    assert table.files().count() == 1 and table.read().columns == orders.columns and rows(table.read()) == rows(orders)
    assert plan_bytes(orders) > 10_000

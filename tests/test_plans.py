"""The plans we rely on."""

from __future__ import annotations

import ast
import pathlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from millrace.operators import charts, filters
from millrace.queries.registry import table

ROOT = pathlib.Path(__file__).resolve().parents[1] / "millrace"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Queries without side effects whose plan can be built at once.
PLAIN = [
    "scan_parquet", "join_left_outer", "join_salted", "join_broadcast", "agg_dedupe",
    "agg_multi_key_count", "agg_describe", "agg_histogram", "agg_density2d", "agg_share",
    "agg_pivot", "word_count", "word_cloud", "filter_global_max", "sliding_window", "top_k",
    "udf_group_fit", "join_positional", "win_row_position", "agg_quantiles", "agg_box",
    "retail_report",
]


@pytest.mark.parametrize("name", PLAIN)
def test_no_cross_joins(spark, sf_dir, name):
    text = plan(contract.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_broadcast_hint(spark, sf_dir):
    assert "BroadcastHashJoin" in plan(contract.queries()["join_broadcast"](spark, sf_dir))


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    text = plan(contract.queries()["top_k"](spark, sf_dir))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    text = plan(contract.queries()["scan_parquet"](spark, sf_dir))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(l_quantity,45.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_shipdate" in text


def test_global_max_is_a_subquery(spark, sf_dir):
    text = plan(filters.at_global_max(table(spark, sf_dir, "lineitem"), "l_quantity"))
    assert "Subquery" in text and "Join" not in text


def test_range_of_a_histogram_is_read_once(spark, sf_dir):
    df = charts.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 5)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert "min(" in optimized and "max(" in optimized


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    text = plan(contract.queries()["agg_dedupe"](spark, sf_dir))
    assert text.index("Exchange") < text.index("row_number(), 1, Partial")
    for name in ("word_count", "sliding_window", "udf_group_fit"):
        assert "partial_" in plan(contract.queries()[name](spark, sf_dir)), name


def test_nothing_collects_whole_frames():
    """No toPandas, localCheckpoint or crossJoin; collect only for lists of bounded length."""
    banned = {"toPandas", "localCheckpoint", "crossJoin", "toLocalIterator", "collect"}
    allowed = {
        ("ml/features.py", "collect"),                  # vocabulary: limited to its size
        ("operators/versioned.py", "toLocalIterator"),  # names of segments
        ("operators/versioned.py", "collect"),          # folders of a commit
        ("operators/keyed.py", "toLocalIterator"),      # folders that a change has emptied
        ("ml/top_items.py", "collect"),                 # steps of norms, a fixed number
        ("ml/labels.py", "collect"),                    # a number for each indexed column
        ("ml/forest_search.py", "collect"),             # a score for each setting of a grid
        ("ml/forest_search.py", "toPandas"),            # a sample whose size is a parameter
        ("queries/learning.py", "collect"),             # points of a curve, terms of topics
    }
    found = set()
    for path in ROOT.rglob("*.py"):
        if "llm" in path.parts:  # has tests of its own
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Attribute) and node.attr in banned:
                found.add((str(path.relative_to(ROOT)), node.attr))
    assert found <= allowed


def test_salting_finds_hot_keys_without_a_shuffle_of_all_keys(spark):
    from millrace.operators.joins import hot_keys

    left = spark.range(1000).selectExpr("IF(id < 600, 0, id) AS k")
    assert hot_keys(left, F.col("k").cast("string"), 0.05) == ["0"]
    sketch = left.agg(F.expr("approx_top_k(xxhash64(k), 40, 800)"))
    assert "hashpartitioning" not in plan(sketch)


def test_coalesce_is_left_to_the_caller(spark):
    assert spark.range(10).repartition(4).coalesce(1).select(
        F.spark_partition_id()).distinct().count() == 1

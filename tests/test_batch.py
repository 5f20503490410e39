"""Operators on small hand-made frames with written-out results."""

from __future__ import annotations

import datetime as dt

import pytest
from tests.conftest import rows
from pyspark.sql import functions as F

from millrace.functions import parsing
from millrace.operators.columns import preview
from millrace.operators import aggregates, charts, columns, filters, joins, ordered, sets
from millrace.scratch import keep


def test_word_count_keeps_empty_words_and_case(spark):
    lines = spark.createDataFrame([("a  b A",), ("",), ("b,",)], "value string")
    want = [("", 2), ("A", 1), ("a", 1), ("b", 1), ("b,", 1)]
    assert rows(aggregates.word_counts(columns.explode_words(lines, "value"))) == want
    assert rows(aggregates.word_counts_functional(lines)) == want


def test_count_of_column_skips_nulls(spark):
    df = spark.createDataFrame([("a",), (None,)], "word string")
    assert rows(df.selectExpr("count(word)", "count(*)")) == [(1, 2)]


def test_dedupe_keeps_first_or_last_and_equal_null_keys(spark):
    df = spark.createDataFrame(
        [(None, 2, "x"), (None, 1, "y"), ("k", 5, None), ("k", 7, "w")],
        "key string, at int, text string",
    )
    assert rows(aggregates.dedupe(df, ["key"], ["at"])) == [("k", 5, None), (None, 1, "y")]
    assert rows(aggregates.dedupe(df, ["key"], ["at"], keep="last")) == [("k", 7, "w"), (None, 2, "x")]
    assert aggregates.dedupe(df, ["key"]).count() == 2
    assert aggregates.dedupe(df.select("key"), ["key"], ["key"]).count() == 2
    with pytest.raises(ValueError):
        aggregates.dedupe(df, ["key"], ["at"], keep="any")


def test_duplicate_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert rows(aggregates.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]


def test_describe_types_and_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (3, "a"), (None, None)], "n int, t string")
    got = {(r["column_name"], r["stat"]): (r["number"], r["text"])
           for r in aggregates.describe(df).collect()}
    assert got == {
        ("n", "count"): (2.0, None), ("n", "mean"): (2.0, None),
        ("n", "stddev"): (1.414214, None), ("n", "min"): (1.0, None), ("n", "max"): (3.0, None),
        ("t", "count"): (2.0, None), ("t", "min"): (None, "a"), ("t", "max"): (None, "b"),
    }


def test_null_counts_and_shape(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(aggregates.null_counts(df)) == [("a", 1), ("b", 2)]
    assert rows(aggregates.shape(df)) == [(2, 2)]
    assert rows(aggregates.shape(df.where("false"))) == [(0, 2)]


def test_global_max_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, None), (4, 1)], "id int, x int")
    assert rows(filters.at_global_max(df, "x")) == [(1, 5), (2, 5)]
    assert filters.at_global_max(df.where("x is null"), "x").count() == 0


def test_rename_and_drop_ignore_absent_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = columns.rename_and_drop(df, {"a": "c", "zz": "y"}, ("b", "fn_wt"))
    assert out.columns == ["c"]


def test_row_ids_are_unique_and_increase(spark):
    got = [r["id"] for r in columns.row_ids(spark.range(100).repartition(5).toDF("v")).collect()]
    assert len(set(got)) == 100 and got == sorted(got)


def test_union_is_by_position(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(1, "x")], "number int, label string")
    assert rows(sets.union_by_position(a, b)) == [(1, "x"), (1, "x")]
    with pytest.raises(ValueError):
        sets.union_by_position(a, b.select("number"))


# -- joins ----------------------------------------------------------------


def test_left_join_null_keys_never_match_and_rows_multiply(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "c string, v int")
    got = rows(joins.join_on(left, right, [("k", "c")], "left_outer"))
    assert got == [("a", "a", 1), ("a", "a", 2), ("b", None, None), (None, None, None)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join_with_a_hot_key(spark, how):
    # Key 0 and the null key hold a third of the rows each; copies among them.
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id")).alias("k"),
        (F.col("id") % 7).alias("v"),
    )
    right = spark.createDataFrame(
        [(0, "hot"), (0, "hot2"), (4, "four"), (None, "null"), (99999, "none")], "c bigint, w string"
    )
    plain = joins.join_on(left, right, [("k", "c")], how)
    salted = joins.salted_join(left, right, [("k", "c")], how, salts=4)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_salted_join_refuses_what_it_cannot_do(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        joins.salted_join(df, df, [("id", "id")], "full")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti", "right", "full"])
def test_broadcast_join_checks_the_bytes(spark, how):
    left = spark.range(100).toDF("a")
    right = spark.range(50).toDF("b")
    size = joins.bytes_up_to(right, 1 << 20)
    small = joins.broadcast_join(left, right, [("a", "b")], how, max_bytes=size)
    large = joins.broadcast_join(left, right, [("a", "b")], how, max_bytes=size - 1)
    assert rows(small) == rows(large)
    hint = "ResolvedHint (strategy=broadcast)"
    assert hint in small._jdf.queryExecution().analyzed().toString()
    assert hint not in large._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_splits_keys_that_are_hot_on_either_side(spark, how):
    left = spark.range(900).select(F.when(F.col("id") < 400, 1).when(F.col("id") < 600, 2).when(F.col("id") == 899, None).otherwise(F.col("id")).alias("k"), "id").repartition(3)
    right = spark.range(300).select(F.when(F.col("id") < 100, 2).when(F.col("id") < 200, 3).otherwise(F.col("id") * 4).alias("j"), F.col("id").alias("r")).repartition(3)
    one = spark.createDataFrame([(1, -1), (700, -2)], "j int, r int")
    right = right.select(F.col("j").cast("int"), F.col("r").cast("int")).union(one)
    left, right = keep(left), keep(right)
    salted = joins.salted_join(left, right, [("k", "j")], how, salts=4, hot_share=0.2)
    plain = left.join(right, left["k"] == right["j"], how)
    assert salted.columns == plain.columns and rows(salted) == rows(plain)
    assert sorted(joins.hot_keys(right, F.col("j").cast("string"), 0.2)) == ["2", "3"]


@pytest.mark.parametrize("types", [("decimal(10,2)", "int"), ("double", "int"), ("string", "string"), ("date", "date")])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_of_keys_of_different_types(spark, how, types):
    def rows_of(n, shift, t):
        value = F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") + shift)
        value = F.date_add(F.lit("2024-01-01"), value.cast("int")) if t == "date" else value.cast(t)
        return spark.range(n).select(value.alias("k"), F.when(F.col("id") % 5 > 0, "x").alias("s"), "id")

    left, right = keep(rows_of(90, 0, types[0])), keep(rows_of(30, 3, types[1]).toDF("k2", "s2", "id2"))
    for pairs in ([("k", "k2")], [("k", "k2"), ("s", "s2")]):
        cond = [left[a] == right[b] for a, b in pairs]
        plain = left.join(right, cond, how)
        assert rows(joins.salted_join(left, right, pairs, how, salts=3, hot_share=0.1)) == rows(plain)


def test_salted_join_of_zeros_of_either_sign(spark):
    left = keep(spark.range(60).select(F.when(F.col("id") % 2 == 0, 0.0).otherwise(-0.0).alias("a")))
    right = spark.createDataFrame([(-0.0, 1), (7.5, 2)], "b double, v int")
    assert joins.salted_join(left, right, [("a", "b")], salts=3).count() == 60


def test_bytes_stop_at_the_bound(spark):
    assert joins.bytes_up_to(spark.range(0), 10) == 0
    assert joins.bytes_up_to(spark.range(1000), 1 << 20) >= 8000
    # each task stops after its first batch
    assert 10 < joins.bytes_up_to(spark.range(0, 1_000_000, 1, 2), 10) < 1_000_000


def test_preview_is_bounded(spark):
    assert len(preview(spark.range(1 << 30))) == 1000       # nobody reads the rest
    assert [r["id"] for r in preview(spark.range(20, 30), 3)] == [20, 21, 22]
    assert preview(spark.range(0)) == []
    with pytest.raises(ValueError):
        preview(spark.range(5), 1001)


def test_positional_join(spark):
    left = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string").repartition(3)
    right = spark.createDataFrame([(20,), (10,)], "w int").repartition(2)
    got = joins.positional_join(left, right, ["k"], ["w"])
    assert rows(got.select("idx", "v", "w")) == [(0, "a", 10), (1, "b", 20), (2, "c", None)]


# -- ordered --------------------------------------------------------------


def test_row_position_counts_through_a_hot_key_and_null_keys(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 2 == 0, "cold").alias("k"), "id"
    )
    got = ordered.row_position(df.repartition(6), ["k"], ["id"]).collect()
    seen: dict = {}
    for r in got:
        seen.setdefault(r["k"], []).append((r["id"], r["position"]))
    assert set(seen) == {"hot", "cold", None}
    for pairs in seen.values():
        assert [p for _, p in sorted(pairs)] == list(range(1, len(pairs) + 1))


def test_index_numbers_copies_too(spark):
    df = spark.createDataFrame([(1,)] * 500 + [(2,)] * 3, "x int").repartition(4)
    got = ordered.row_index(df, ["x"], spread_ties=True).collect()
    assert sorted(r["idx"] for r in got) == list(range(503))
    assert sorted(r["idx"] for r in got if r["x"] == 2) == [500, 501, 502]


@pytest.mark.parametrize("way", ["brackets", "sort"])
def test_percentiles_are_exact_for_hot_values_and_single_rows(spark, monkeypatch, way):
    import numpy as np

    values = [7.0] * 600 + [float((i * 37) % 1000) for i in range(900)]
    data = [("big", v) for v in values] + [("one", 3.5)] + [("none", None)] + [(None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(data, "k string, x double").repartition(5)
    qs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    if way == "sort":
        monkeypatch.setattr(ordered, "_bracketed", lambda *a: None)
    found = ordered.exact_percentiles(df, ["k"], "x", qs)
    got = {(r["k"], r["q"]): r["x"] for r in found.collect()}
    assert len(got) == 3 * len(qs)
    for q in qs:
        assert got["big", q] == pytest.approx(np.quantile(values, q), abs=1e-9)
        assert got["one", q] == 3.5
        assert got[None, q] == pytest.approx(1 + q)


def test_percentiles_survive_a_sketch_that_misses(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).cast("double").alias("x"))
    got = {r["q"]: r["x"] for r in
           ordered.exact_percentiles(df, [], "x", [0.3, 0.5, 0.999], accuracy=3).collect()}
    assert got == {q: pytest.approx(q * 4999) for q in (0.3, 0.5, 0.999)}


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_percentiles_of_many_values_are_narrowed(spark, monkeypatch, keys):
    import numpy as np

    monkeypatch.setattr(ordered, "WINDOW_ROWS", 20)
    monkeypatch.setattr(ordered, "CELLS", 4)
    df = spark.range(9000).select((F.col("id") % 2).alias("k"), (F.col("id") * 7919 % 3001).cast("double").alias("x"))
    nan = spark.range(300).select((F.col("id") % 2).alias("k"), F.lit(float("nan")).alias("x"))
    qs = [0.0, 0.01, 0.333, 0.5, 0.9, 1.0]
    got = {(*[r[k] for k in keys], r["q"]): r["x"] for r in ordered.exact_percentiles(df, keys, "x", qs, accuracy=100).collect()}
    for k in (0, 1):
        x = sorted((i * 7919 % 3001) for i in range(9000) if not keys or i % 2 == k)
        assert all(got[(k, q) if keys else (q,)] == pytest.approx(np.quantile(x, q), abs=1e-9) for q in qs)
    # not-a-number is above all numbers, as in sorting
    mixed = {r["q"]: r["x"] for r in ordered.exact_percentiles(df.unionByName(nan), [], "x", [0.5, 0.96, 0.99], accuracy=100).collect()}
    x = sorted(i * 7919 % 3001 for i in range(9000))
    assert mixed[0.5] == pytest.approx(np.quantile(x + [9e9] * 300, 0.5)) and mixed[0.96] == pytest.approx(np.quantile(x + [9e9] * 300, 0.96))
    assert mixed[0.99] != mixed[0.99]
    assert ordered.exact_percentiles(df.limit(0), keys, "x", qs).count() == 0


@pytest.mark.parametrize("way", ["brackets", "sort"])
def test_percentiles_of_infinities_and_repeated_quantiles(spark, monkeypatch, way):
    inf = float("inf")
    if way == "sort":
        monkeypatch.setattr(ordered, "_bracketed", lambda *a: None)
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(inf,), (inf,)], "x double")
    got = rows(ordered.exact_percentiles(df, [], "x", [0.5, 1.0, 0.5]))
    assert got == [(0.5, 5.5), (0.5, 5.5), (1.0, inf)]
    low = spark.createDataFrame([(-inf,), (-inf,), (1.0,)], "x double")
    assert rows(ordered.exact_percentiles(low, [], "x", [0.0, 0.5, 1.0])) == [(0.0, -inf), (0.5, -inf), (1.0, 1.0)]


# -- charts ---------------------------------------------------------------


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (4.9,), (5.0,), (10.0,), (None,)], "x double")
    assert rows(charts.histogram(df, "x", 2)) == [(0, 2), (1, 2)]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert rows(charts.histogram(flat, "x", 4)) == [(0, 2)]


def test_pivot_and_shares(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 5)], "k string, s string, v int")
    got = charts.pivot_table(df, ["k"], "s", ["x", "y"], F.sum("v"))
    assert rows(got) == [("a", 1, 2), ("b", 5, None)]
    points = charts.series(df, ["k"], v=F.sum("v"))
    assert rows(charts.shares(points, "v")) == [("a", 3, 0.375), ("b", 5, 0.625)]


def test_box_with_outlier(spark):
    df = spark.createDataFrame([("k", float(v)) for v in [1, 2, 3, 4, 100]], "k string, x double")
    box = charts.box_plot(df, "x", ["k"]).first()
    assert (box["q1"], box["median"], box["q3"]) == (2.0, 3.0, 4.0)
    assert (box["low_whisker"], box["high_whisker"], box["outliers"]) == (1.0, 4.0, 1)
    assert rows(charts.box_outliers(df, "x", ["k"])) == [("k", 100.0)]


def test_qq_against_normal(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    got = {r["q"]: (r["x"], r["normal"]) for r in charts.qq_normal(df, "x", [0.1, 0.5]).collect()}
    assert got[0.5] == (5.0, pytest.approx(0.0))
    assert got[0.1] == (1.0, pytest.approx(-1.2815515655446004))


def test_sample_is_repeatable_and_splits(spark):
    df = spark.range(4000)
    kept = df.where(charts.hash_below(["id"], 0.25))
    again = df.repartition(7).where(charts.hash_below(["id"], 0.25))
    assert rows(kept) == rows(again)
    assert 850 < kept.count() < 1150
    assert df.where(charts.hash_below(["id"], 1)).count() == 4000
    assert df.where(charts.hash_below(["id"], 0)).count() == 0
    with pytest.raises(ValueError):
        charts.hash_below(["id"], 1.5)


def test_word_cloud_counts_distinct_texts(spark):
    df = spark.createDataFrame(
        [("a b", "en"), ("a b", "en"), ("a", "en"), ("a", "fr")], "text string, lang string"
    )
    assert rows(charts.word_cloud(df, "text", "lang = 'en'")) == [("a", 2), ("b", 1)]


# -- scalar functions -----------------------------------------------------


def test_bad_values_become_null(spark):
    df = spark.createDataFrame(
        [("1", "01/2/24 10:15"), ("C5", "1/2/24 10:15"), (None, "01/2/24 9:15"), ("2.5", "x")],
        "n string, t string",
    )
    got = df.select(
        parsing.to_type("n", "double").alias("n"), parsing.to_time("t").alias("t")
    ).collect()
    assert [r["n"] for r in got] == [1.0, None, None, 2.5]
    assert [r["t"] for r in got] == [dt.datetime(2024, 2, 1, 10, 15), None, None, None]


def test_fill_touches_numbers_only(spark):
    df = spark.createDataFrame([(None, None, None)], "i int, d double, s string")
    assert rows(parsing.zero_for_null(df)) == [(0, 0.0, None)]


def test_json_round_trip_and_malformed(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, s string")
    messages = parsing.to_message(df, "id")
    assert [r["key"] for r in messages.collect()] == ["1", "2"]
    back = messages.select(parsing.from_message("value", df.schema).alias("m")).select("m.*")
    assert rows(back) == rows(df)
    bad = spark.createDataFrame([("{oops",)], "value string")
    got = bad.select(parsing.from_message("value", "a int, b string").alias("m")).select("m.*")
    assert rows(got) == [(None, None)]


def test_current_time_is_one_value_per_query(spark):
    got = spark.range(3).select(F.current_timestamp().alias("t")).distinct()
    assert got.count() == 1

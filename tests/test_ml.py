"""Feature transforms, learners, scoring."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from tests.conftest import rows

from millrace import scratch
from millrace.ml import features, forest_search, group_models, models, scoring, top_items
from millrace.ml.labels import LabelNumbers
from millrace.plans import feature_job


@pytest.fixture(scope="module")
def line(spark):
    """label = 3 x + 1, class by x > 50."""
    df = spark.range(100).select(
        "id", F.col("id").cast("double").alias("x"), (F.col("id") * 3.0 + 1).alias("label"),
        (F.col("id") > 50).cast("double").alias("cls"),
    )
    return features.assembler(["x"], "features").transform(df).cache()


def test_mixture_of_distinct_rows_with_weights(spark):
    """Iterations cost distinct rows, and the parts' shares are those of all rows."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.lit(100.0)).alias("x"), (F.col("id") % 5).cast("double").alias("y"))
    few = models.weighted(features.assembler(["x", "y"], "features").transform(df), ["features"])
    assert few.count() == 10 and few.agg(F.sum("weight")).first()[0] == 3000
    model = models.gaussian_mixture(2, weightCol="weight").fit(models.prepared(few))
    means = sum(w * g.mean.toArray() for w, g in zip(model.weights, model.gaussians))
    assert sum(model.weights) == pytest.approx(1) and means == pytest.approx([200 / 3, 2.0])


def test_tokens_and_stop_words(spark):
    df = spark.createDataFrame([("The Red  HAT",)], "text string")
    terms = features.tokenizer("text", "terms").transform(df)
    assert terms.first()["terms"] == ["the", "red", "", "hat"]
    kept = features.stop_words_remover("terms", "kept").transform(terms)
    assert kept.first()["kept"] == ["red", "", "hat"]


def test_large_vocabulary_reaches_the_model_at_once(spark, monkeypatch):
    """Not term by term: each would be a call to the JVM."""
    monkeypatch.setattr("pyspark.ml.feature.CountVectorizerModel._new_java_array", None)
    terms = [f"w{i:05d}" for i in range(20_000)] + ["", "\u00e4\U0001f600"]
    df = spark.createDataFrame([(terms,), (["w00007", "", ""],)], "terms array<string>")
    known = features.vocabulary(df, "terms")
    assert known[:2] == ["", "w00007"] and sorted(known) == sorted(terms)
    model = features.counter(known, "terms", "v")
    found = model.transform(df).select(features.vector_to_array("v").alias("v")).collect()
    assert len(found[0].v) == 20_002 and set(found[0].v) == {1.0}
    assert [(i, n) for i, n in enumerate(found[1].v) if n] == [(0, 2.0), (1, 1.0)]


def test_vocabulary_breaks_ties_and_honours_min_df(spark):
    df = spark.createDataFrame([(["b", "a", "z", "z"],), (["a", "b"],)], "terms array<string>")
    assert features.vocabulary(df, "terms", 3, min_df=2) == ["a", "b"]
    assert features.vocabulary(df, "terms", 1) == ["a"]
    model = features.count_vectorizer(df, "terms", "v", 2, 2)
    assert rows(model.transform(df).select(features.vector_to_array("v")[0])) == [(1.0,), (1.0,)]


def test_string_index_order_and_skip(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,)], "k string")
    got = features.string_index(df, "k", "i").transform(df)
    assert rows(got.distinct()) == [("a", 1.0), ("b", 0.0), ("c", 2.0)]
    assert got.columns == ["k", "i"]
    assert rows(features.string_index(df.where("k = 'a'"), "k", "i").transform(df)) == [("a", 0.0)]


def test_one_hot_drops_the_last(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "i double")
    got = features.one_hot("i", "v").fit(df).transform(df)
    arrays = [r[0] for r in got.orderBy("i").select(features.vector_to_array("v")).collect()]
    assert arrays == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]


def test_binarizer_is_strict(spark):
    df = spark.createDataFrame([(10.0,), (10.1,)], "p double")
    assert rows(features.binarizer("p", "b", 10).transform(df)) == [(10.0, 0.0), (10.1, 1.0)]


def test_word_vectors_are_means_of_words(spark):
    df = spark.createDataFrame([(["a"],), (["b"],), (["a", "b"],)], "t array<string>")
    model = features.word_vectors(df, "t", "v", parts=1)
    a, b, ab = [r["v"].toArray() for r in model.transform(df).collect()]
    assert np.allclose(ab, (a + b) / 2)


def test_chi_square_picks_the_dependent_feature(spark):
    df = spark.range(200).select(
        (F.col("id") % 3).cast("double").alias("noise"), (F.col("id") % 2).cast("double").alias("y")
    ).withColumn("same", F.col("y"))
    vectors = features.assembler(["noise", "same"], "f").transform(df)
    assert features.chi_square_selector("f", "y", "out").fit(vectors).selectedFeatures == [1]


def test_linear_regression_finds_the_line(line):
    model = models.linear_regression(regParam=0.0, elasticNetParam=0.0).fit(line)
    assert model.coefficients[0] == pytest.approx(3) and model.intercept == pytest.approx(1)


@pytest.mark.parametrize("make", [
    models.tree_regressor, models.forest_regressor, models.boosted_regressor,
])
def test_regressors_fit_and_repeat(line, make):
    learner = make()
    first = models.regression_metrics(learner.fit(line).transform(line))
    again = models.regression_metrics(learner.fit(line).transform(line))
    assert first == again and first["r2"] > 0.9


@pytest.mark.parametrize("make", [
    models.tree_classifier, models.forest_classifier, models.boosted_classifier,
    models.naive_bayes, models.linear_svm,
])
def test_classifiers_separate_separable_data(line, make):
    model = make("cls").fit(line)
    assert models.class_metrics(model.transform(line), "cls")["accuracy"] > 0.9


def test_logistic_regressions(line):
    loose = models.logistic_regression("cls", regParam=0.0).fit(line)
    assert models.ranking_metrics(loose.transform(line), label="cls")["auc"] == pytest.approx(1.0)
    many = models.multinomial_regression("cls").fit(line)
    assert many.numClasses == 2 and many.coefficientMatrix.numRows == 2


@pytest.mark.parametrize("make, far", [
    (models.k_means, 200.0), (models.gaussian_mixture, 200.0),
    (models.bisecting_k_means, 900.0),      # at 200 the first cut would halve the middle heap
])
def test_clusters_of_three_heaps(spark, make, far):
    points = [(Vectors.dense([c + e]),) for c in (0.0, 100.0, far) for e in (0, 1, 2, 3)]
    df = spark.createDataFrame(points, ["features"])
    found = make().fit(df).transform(df).groupBy("prediction").count().collect()
    assert sorted(r["count"] for r in found) == [4, 4, 4]


def test_ratings_drop_ids_that_are_no_numbers(spark):
    df = spark.createDataFrame(
        [("1", "2", "3"), ("C1", "2", "3"), ("1", "22A", "3"), ("1", "2", "x")],
        "u string, i string, r string")
    assert rows(models.ratings(df, "u", "i", "r")) == [(1, 2, 3), (1, 2, None)]


def test_factors_drop_cold_pairs_and_recommend(spark):
    seen = spark.createDataFrame(
        [(u, i, float((u + i) % 5 + 1)) for u in range(8) for i in range(9)],
        "user_id int, item_id int, rating float")
    model = models.factors().fit(seen)
    cold = spark.createDataFrame([(1, 1, 1.0), (99, 1, 1.0)], seen.schema)
    assert model.transform(cold).count() == 1
    assert models.top_items(model).groupBy("user_id").count().where("count = 5").count() == 8
    assert models.top_users(model).groupBy("item_id").count().where("count = 5").count() == 9


def test_split_is_stable_and_complete(spark):
    df = spark.range(1000)
    train, test = models.stable_split(df, ["id"], 0.8)
    assert train.count() + test.count() == 1000 and train.intersect(test).count() == 0
    other = models.stable_split(df.where("id < 100").repartition(3), ["id"], 0.8)[0]
    assert rows(other) == rows(train.where("id < 100"))


def test_grid_has_one_row_per_setting(line):
    best, table = models.grid_search(
        models.linear_regression(), models.regression_evaluator(), line,
        {"regParam": [0.0, 50.0], "elasticNetParam": [0.0, 1.0]})
    assert table.count() == 4 and best.getRegParam() == 0.0


def test_saved_model_scores_the_same(spark, line):
    model = models.linear_regression().fit(line)
    path = scratch.new_path(spark, "model")
    scoring.save_model(model, path)
    scoring.save_model(model, path)
    out = scoring.score_table(scoring.load_model(path), line, scratch.new_path(spark, "scored"))
    assert "features" not in out.columns
    assert rows(out.select("id", "prediction")) == rows(
        model.transform(line).select("id", "prediction"))


def test_score_column_and_group_fits(spark):
    rng = np.random.default_rng(1)
    data = [(("a", "b")[i % 2], float(x), float(z), float((2 + i % 2) * x - z + 4))
            for i, (x, z) in enumerate(rng.normal(size=(60, 2)))]
    df = spark.createDataFrame(data, "k string, x double, z double, y double").repartition(4)
    scored = df.withColumn("s", scoring.score_column(scoring.linear_model([1.0, 2.0], 3.0), ["x", "z"]))
    for r in scored.collect():
        assert r["s"] == pytest.approx(r["x"] + 2 * r["z"] + 3)
    fits = {r["k"]: r for r in scoring.fit_per_group(df, ["k"], ["x", "z"], "y").collect()}
    assert fits["a"]["coefficients"] == pytest.approx([2, -1])
    assert fits["b"]["coefficients"] == pytest.approx([3, -1])
    assert fits["a"]["intercept"] == pytest.approx(4) and fits["b"]["n"] == 30


def test_feature_job(spark):
    data = [(i, i % 3, f"red hat {i % 2}", ("EN", "FR", "DE")[i % 3], i % 4, 9.0 + i % 3,
             f"0{1 + i % 9}/{1 + i % 2}/24 10:00", "30", "x1") for i in range(30)]
    raw = spark.createDataFrame(
        data + data[:5] + [(99, 1, None, "EN", 1, 1.0, "bad", None, None)],
        "invoice_num int, stock_code int, description string, country_code string, quantity int, "
        "unit_price double, invoice_date string, age string, work_class string")
    clean = feature_job.wrangle(
        raw, ("invoice_num", "invoice_date", "stock_code"), ("quantity",),
        {"cust_age": "age", "work_type": "work_class"}, "invoice_date", "invoice_time",
        "dd/M/yy HH:mm", ("age", "description"))
    assert clean.count() == 30
    assert rows(clean.select("cust_age", "work_type").distinct()) == [(30.0, 0.0)]
    out = feature_job.build_features(clean)
    assert out.count() == 30
    # price 10 is not above 10
    assert rows(out.groupBy("binarized_price").count()) == [(0.0, 20), (1.0, 10)]
    first = out.first()
    assert first["features"].size == 2 + 2 + 1 + 1 + 1
    assert first["selected_features"].toArray()[0] == pytest.approx(first["scaled_features"][1])
    stored = feature_job.save_features(
        out, scratch.work_database(spark), scratch.new_name("features"),
        scratch.new_path(spark, "features"))
    assert stored.count() == 30


def test_pandas_style_api(spark):
    frame = spark.createDataFrame([(1.0, None), (3.0, "x")], "a double, b string").pandas_api()
    assert len(frame.head(1)) == 1
    assert frame.isnull().sum().to_pandas().to_dict() == {"a": 0, "b": 1}
    assert frame.describe().to_pandas().loc["mean", "a"] == 2.0


def _same(a, b):
    return rows(a.select(*[features.vector_to_array(c).alias(c) if c in ("desc_vec", "country_ohe", "features", "scaled_features", "selected_features")
                           else c for c in a.columns])) == rows(b.select(*[
        features.vector_to_array(c).alias(c) if c in ("desc_vec", "country_ohe", "features", "scaled_features", "selected_features") else c for c in b.columns]))


RETAIL = "id int, description string, country_code string, quantity int, unit_price double, invoice_time timestamp"


def _retail(spark, n, country=("DE", "FR", "DE", "IT")):
    import datetime as dt

    data = [(i, f"red hat {i % 3}", country[i % len(country)], i % 5, float(i % 20), dt.datetime(2024, 1 + i % 12, 3)) for i in range(n)]
    return spark.createDataFrame(data, RETAIL)


def test_feature_job_is_the_same_after_loading(spark, folder):
    model = feature_job.fit_features(_retail(spark, 60))
    scoring.save_model(model, folder)
    again = scoring.load_model(folder)
    new = _retail(spark, 30, ("IT", "FR", "XX", None))
    first, second = model.transform(new), again.transform(new)
    assert first.count() == 16 and _same(first, second)
    labels = {(r["column"], r["label"]): r["number"] for r in again.stages[4].labels.collect()}
    assert labels[0, "DE"] == 0 and labels[0, "FR"] == 1 and labels[0, "IT"] == 2


def test_feature_job_loads_in_another_process(spark, folder):
    import pathlib
    import subprocess
    import sys

    scoring.save_model(feature_job.fit_features(_retail(spark, 60)), folder)
    new = _retail(spark, 20)
    new.write.parquet(f"{folder}-new")
    code = (
        "import sys; from millrace.session import build_session; from millrace.ml import scoring\n"
        "s = build_session('other', 'local[2]', 2, spark__ui__enabled='false')\n"
        "scoring.load_model(sys.argv[1]).transform(s.read.parquet(sys.argv[1] + '-new')).write.parquet(sys.argv[1] + '-out')\n")
    subprocess.run([sys.executable, "-c", code, folder], check=True, timeout=300, cwd=pathlib.Path(__file__).parents[1], capture_output=True)
    assert _same(spark.read.parquet(f"{folder}-out"), scoring.load_model(folder).transform(new))


def test_label_numbers_of_several_columns(spark):
    df = spark.createDataFrame([("b", 7), ("b", 8), ("a", 7), ("c", None), (None, 7)], "k string, n int")
    model = LabelNumbers(inputs=["k", "n"], outputs=["ki", "ni"]).fit(df)
    assert rows(model.transform(df).select("k", "n", "ki", "ni")) == [("a", 7, 1.0, 0.0), ("b", 7, 0.0, 0.0), ("b", 8, 0.0, 1.0)]
    assert model.transform(df).schema["ki"].metadata["ml_attr"]["num_vals"] == 3
    empty = LabelNumbers(inputs=["k", "n"], outputs=["ki", "ni"]).fit(df.limit(0))
    assert empty.transform(df).count() == 0


def _points(spark, n=600):
    df = spark.range(n).select(
        "id", (F.col("id") % 37).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"),
        F.expr("double(id % 37 > 18 AND id % 11 > 3)").alias("label"))
    return models.prepared(features.assembler(["a", "b"], "features").transform(df).select("id", "features", "label"))


def test_survivors_have_the_scores_of_plain_fits(spark):
    from pyspark.ml.classification import RandomForestClassifier

    train = _points(spark)
    grid = {"maxDepth": [1, 6], "featureSubsetStrategy": ["1", "2"], "minInstancesPerNode": [1], "bootstrap": [True],
            "impurity": ["gini", "entropy"], "numTrees": [2, 6]}
    found = forest_search.halving_search(train, ["id"], grid, folds=2, rows=200, growth=4, finalists=2)
    tried = found.tried.collect()
    assert [sum(r.rung == i for r in tried) for i in range(3)] == [16, 4, 2] and {r.rows for r in tried} == {200, 600}
    last = [r for r in tried if r.rung == 2]
    best = max(last, key=lambda r: r.metric)
    assert f"maxDepth={found.best.getMaxDepth()}," in best.setting and f"impurity={found.best.getImpurity()}," in best.setting
    folds = train.withColumn("f", F.pmod(F.xxhash64("id"), F.lit(2)))
    for r in last:
        setting = dict(p.split("=") for p in r.setting.split(", "))
        learner = RandomForestClassifier(maxDepth=int(setting["maxDepth"]), featureSubsetStrategy=setting["featureSubsetStrategy"], minInstancesPerNode=1, bootstrap=True,
                                         impurity=setting["impurity"], numTrees=int(setting["numTrees"]), seed=models.SEED)
        plain = [models.class_metrics(learner.fit(folds.where(f"f <> {i}")).transform(folds.where(f"f = {i}")))["accuracy"] for i in range(2)]
        assert abs(r.metric - sum(plain) / 2) < 1e-12


def test_grid_has_every_setting_that_the_learner_can_express():
    settings = forest_search.settings_of(forest_search.GRID)
    assert len({forest_search.named(s) for s in settings}) == len(settings) == 2 * 3 * 3 * 2 * 2 * 4


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_a_grown_tree_separates_what_bins_can(impurity):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 8, (400, 3))
    y = ((x[:, 0] > 3) ^ (x[:, 1] > 5)).astype(int)
    tree = forest_search.grown(x, y, np.ones(400), 2, 30, 3, 1, impurity, rng, x)
    assert (tree.argmax(axis=1) == y).all() and np.allclose(tree.sum(axis=1), 1)
    stump = forest_search.grown(x, y, np.ones(400), 2, 0, 3, 1, impurity, rng, x)
    assert np.allclose(stump[:, 1], y.mean())
    large = forest_search.grown(x, y, np.ones(400), 2, 30, 3, 300, impurity, rng, x)
    assert np.allclose(large[:, 1], y.mean())  # no split leaves 300 rows on both sides


@pytest.mark.parametrize("item_block,user_block", [(4, 1000), (16, 7), (500, 3)])
def test_best_by_product_equals_all_pairs(spark, item_block, user_block):
    rng = np.random.default_rng(2)
    items = [(i, (rng.standard_normal(4) * rng.pareto(2)).tolist()) for i in range(90)] + [(90 + i, [0.5, 0.5, 0.0, 0.0]) for i in range(9)] + [(200, [0.0] * 4)]
    users = [(i, rng.standard_normal(4).tolist()) for i in range(60)] + [(70, [1.0, 1.0, 0.0, 0.0]), (71, [0.0] * 4), (72, None)]
    frames = [spark.createDataFrame(x, "id long, vector array<double>") for x in (users, items)]
    got = top_items.best_by_product(*frames, 5, item_block, user_block).collect()
    for u, v in users[:61]:
        scores = sorted(((float(np.dot(v, w)), i) for i, w in items), key=lambda x: (-x[0], x[1]))[:5]
        own = sorted((r["rank"], r["item"], r["score"]) for r in got if r["user"] == u)
        assert [r[0] for r in own] == [1, 2, 3, 4, 5]
        assert np.allclose([r[2] for r in own], [s for s, _ in scores])
        assert {r[1] for r in own} == {i for _, i in scores}
    assert {r["user"] for r in got} == {u for u, _ in users[:61]}
    if item_block == 16:    # the long tail of items is met by few
        assert sum(r["blocks"] for r in got) < 0.6 * len(got) * 7
    assert top_items.best_by_product(frames[0], frames[1].limit(0), 5).count() == 0
    assert top_items.best_by_product(frames[0].limit(0), frames[1], 5).count() == 0
    few = top_items.best_by_product(frames[0], frames[1].where("id < 3"), 5, 2, 9)
    assert few.groupBy("user").count().where("count = 3").count() == 61


def test_best_by_product_over_many_chunks(spark, monkeypatch):
    """A chunk of few blocks: users of like depth meet several chunks, and none is left out."""
    monkeypatch.setattr(top_items, "SPAN", 2)
    monkeypatch.setattr(top_items, "CROWDS", 2)
    rng = np.random.default_rng(6)
    items, users = rng.standard_normal((300, 6)) + 0.3, rng.standard_normal((150, 6))
    items[250:] = items[249]                            # copies tie
    frames = [spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>") for x in (users, items)]
    got = top_items.best_by_product(*frames, 5, 10, 20).collect()
    assert len(got) == 5 * len(users) and max(r["blocks"] for r in got) > 2
    for u, v in enumerate(users):
        score = (items * v).sum(axis=1)
        assert [r["item"] for r in sorted((r for r in got if r["user"] == u), key=lambda r: r["rank"])] == np.lexsort((np.arange(300), -score))[:5].tolist()


def test_few_products_of_a_block_are_sorted(monkeypatch):
    rng = np.random.default_rng(7)
    rows = rng.standard_normal((4096, 10))
    rows = rows[np.argsort(-np.sqrt((rows * rows).sum(axis=1)))]
    users, taken = rng.standard_normal((512, 10)), []
    take = top_items._Best._take
    monkeypatch.setattr(top_items._Best, "_take", lambda self, which, *a: (taken.append(len(which)), take(self, which, *a)))
    best = top_items._Best(users, np.full(512, -np.inf), 5)
    best.meet(np.arange(4096), rows, np.sqrt((rows * rows).sum(axis=1)), 1024)
    assert (best.ids == np.argsort(-(users @ rows.T), axis=1)[:, :5]).all()
    assert sum(taken) < 40 * 512


def test_top_items_agree_with_the_library(spark):
    data = [(u, i, float((u * 7 + i * 3) % 11)) for u in range(40) for i in range(60) if (u * i) % 3]
    model = models.factors().fit(spark.createDataFrame(data, "user_id int, item_id int, rating double"))
    want = {(r.user_id, n): r.recommendations[n].rating for r in model.recommendForAllUsers(5).collect() for n in range(5)}
    got = {(r.user_id, r["rank"] - 1): r.rating for r in models.top_items(model, item_block=8, user_block=16).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 for k in want)


def test_streamed_groups_fit_like_closed_form(spark):
    rng = np.random.default_rng(4)
    n = 5000
    data = [(None if i % 50 == 0 else "big" if i % 10 else f"g{i % 3}", float(a), float(b), float(3 * a - 2 * b + 7 + e))
            for i, (a, b, e) in enumerate(zip(rng.standard_normal(n) + 1000, rng.random(n), rng.standard_normal(n)))]
    data += [("one", 2.0, 1.0, 5.0), ("big", None, 1.0, 1.0), ("none", None, 1.0, 1.0)]
    df = spark.createDataFrame(data, "k string, a double, b double, y double").repartition(4)
    got = {r["k"]: r for r in group_models.fit_streamed(df, ["k"], ["a", "b"], "y", salts=3).collect()}
    assert got.keys() == {None, "big", "g0", "g1", "g2", "one"}
    for k, r in got.items():
        own = np.array([x[1:] for x in data if x[0] == k and x[1] is not None])
        assert r["n"] == len(own)
        if k == "one":
            assert r["r2"] is None and abs(r["intercept"] + 2 * r["coefficients"][0] + r["coefficients"][1] - 5) < 1e-9
            continue
        w = np.linalg.lstsq(np.c_[np.ones(len(own)), own[:, :2]], own[:, 2], rcond=None)[0]
        assert np.allclose([r["intercept"], *r["coefficients"]], w, rtol=1e-8)
    assert group_models.fit_streamed(df.limit(0), ["k"], ["a"], "y").count() == 0


def test_a_training_piece_is_bounded_by_rows(spark):
    """However small the rows are on disk; before, a scan packed all files into as many tasks as cores."""
    df = spark.range(0, 40_000, 1, 2).selectExpr("id", "id % 3 AS k", "double(1) AS label")
    got = models.prepared(df, 1000)
    sizes = got.groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count"), F.sum("count")).first() == (1000, 40_000)
    assert got.join(spark.range(3).withColumnRenamed("id", "k"), "k").count() == 40_000   # with a frame of the caller's session
    assert spark.conf.get("spark.sql.files.openCostInBytes") != spark.conf.get("spark.sql.files.maxPartitionBytes")


def test_metrics_predict_once(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    data = [(float(i), 1.1 * i + i % 3) for i in range(50)]
    met = spark.sparkContext.accumulator(0)

    def seen(frames):
        for frame in frames:
            met.add(len(frame))
            yield frame

    df = spark.createDataFrame(data, "prediction double, label double")
    found = models.regression_metrics(df.mapInPandas(seen, df.schema))
    assert met.value == 50
    for name, value in found.items():
        assert value == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df), abs=1e-12)
    blank = models.regression_metrics(df.union(df.limit(1).selectExpr("CAST(NULL AS double)", "label")))
    assert all(np.isnan(v) for v in blank.values())
    with pytest.raises(ValueError):
        models.regression_metrics(df.limit(0))


def test_moments_give_the_same_search(spark):
    df = spark.range(3000).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 7 * 3 + F.pmod(F.xxhash64("id"), F.lit(90))).cast("double").alias("label"))
    folded = features.assembler(["x"], "features").transform(df).withColumn("fold", models.fold_of(["id"], 2)).select("fold", "features", "label")
    few = models.moments(folded, ["fold", "features"])
    assert few.count() == 2 * 2 * 7 and few.agg(F.sum("weight")).first()[0] == 3000
    grid = {"regParam": [0.1, 3.0], "fitIntercept": [False, True], "elasticNetParam": [0.0, 0.5, 1.0]}
    best, plain = models.grid_search(models.linear_regression(), models.regression_evaluator(), folded, grid, fold="fold")
    same, short = models.grid_search(
        models.linear_regression(weightCol="weight"), models.regression_evaluator(weightCol="weight"), few, grid, fold="fold")
    expected, got = (dict(t.collect()) for t in (plain, short))
    assert expected.keys() == got.keys() and len(got) == 12
    assert all(got[k] == pytest.approx(v, rel=1e-9) for k, v in expected.items())
    assert same.coefficients[0] == pytest.approx(best.coefficients[0], rel=1e-9) and same.intercept == pytest.approx(best.intercept, rel=1e-9)
    one = spark.createDataFrame([(1, 5.0), (2, None)], "k int, label double")
    assert rows(models.moments(one, ["k"])) == [(1, 5.0, 1.0), (2, None, 1.0)]


def test_survivors_are_fitted_to_distinct_rows_without_python(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier

    train, plans = _points(spark), []
    fit = forest_search.RandomForestClassifier.fit

    def seen(self, df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        assert df.schema["label"].metadata["ml_attr"]["num_vals"] == 2
        return fit(self, df, *rest)

    monkeypatch.setattr(forest_search.RandomForestClassifier, "fit", seen)
    grid = {"maxDepth": [1, 2, 3], "featureSubsetStrategy": ["2"], "minInstancesPerNode": [1], "bootstrap": [False], "impurity": ["gini"], "numTrees": [2]}
    found = forest_search.halving_search(train, ["id"], grid, folds=2)
    monkeypatch.undo()
    assert len(plans) == 5 and not any("Python" in p or "InMemoryTableScan" in p for p in plans)
    assert found.best.transform(train).select("prediction", "probability").count() == 600
    assert found.best.getWeightCol() == "weight" and found.best.trees[0].numNodes > 1
    weighted = found.tried.where("rung = 1").collect()
    folds = train.withColumn("f", F.pmod(F.xxhash64("id"), F.lit(2)))
    for r in weighted:
        depth = int(dict(p.split("=") for p in r.setting.split(", "))["maxDepth"])
        learner = RandomForestClassifier(maxDepth=depth, featureSubsetStrategy="2", bootstrap=False, impurity="gini", numTrees=2, seed=models.SEED)
        plain = [models.class_metrics(learner.fit(folds.where(f"f <> {i}")).transform(folds.where(f"f = {i}")))["accuracy"] for i in range(2)]
        assert abs(r.metric - sum(plain) / 2) < 1e-9


def test_feature_job_splits_each_text_once(spark, folder):
    """The stages of texts run on distinct descriptions, and every row gets what they would make of it."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer

    from millrace.ml.values import EachValue

    base = _retail(spark, 60)
    model = feature_job.fit_features(base)
    texts = [s for s in model.stages if type(s).__name__ == "EachValueModel"]
    assert [s.getOrDefault("columns") for s in texts] == [["description"], ["desc_nostops"]]
    plain = base.select("id", "description")
    for s in texts:
        plain = s.fitted.transform(plain)
    job = model.transform(base).select(*plain.columns)
    assert _same(plain, job)
    calls = spark.sparkContext.accumulator(0)

    def counted(text):
        calls.add(1)
        return text.lower().split(" ")

    spark.udf.register("counted_split", counted, "array<string>")
    once = EachValue(columns=["description"], stages=[SQLTransformer(statement="SELECT *, counted_split(description) AS terms FROM __THIS__")])
    out = once.fit(base).transform(base)
    assert out.count() == 60 and calls.value == base.select("description").distinct().count() < 60
    # the unfitted job can be saved too, and nulls are a value
    unfitted = EachValue(columns=["k"], stages=[features.binarizer("x", "y", 1.0)])
    Pipeline(stages=[EachValue(columns=["k", "x"], stages=unfitted.stages)]).save(folder)
    again = Pipeline.load(folder).fit(spark.createDataFrame([("a", 1.0)], "k string, x double"))
    rows_in = spark.createDataFrame([(None, 2.0), (None, 2.0), ("a", 1.0)], "k string, x double")
    assert rows(again.transform(rows_in)) == [("a", 1.0, 0.0), (None, 2.0, 1.0), (None, 2.0, 1.0)]


def test_order_lines_are_read_once(spark, sf_dir):
    from millrace.queries.features import retail_rows

    text = retail_rows(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [l_orderkey") == 1

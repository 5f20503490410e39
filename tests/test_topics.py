"""Vocabularies as tables and topic models over them."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.clustering import LDA
from pyspark.sql import functions as F
from tests.conftest import rows

from millrace.ml import features, models, topics
from millrace.queries import learning
from millrace.scratch import keep

ROUTES = pytest.mark.parametrize("sent", [0, 3, 1 << 18], ids=["joined", "both", "sent"])


@pytest.fixture(scope="module")
def docs(spark):
    """Two subjects with thirty terms each that share five; three documents know nothing."""
    draw = np.random.default_rng(3)
    texts = [[f"{'ab'[i % 2]}{n}" if n < 30 else f"c{n}" for n in draw.integers(0, 35, 40)] for i in range(240)]
    texts += [["only", "only"], [], ["once"]]
    return keep(spark.createDataFrame([(i % 200, t) for i, t in enumerate(texts)], "doc_id int, terms array<string>"))


def counted(docs, min_df=2):
    known = features.vocabulary_table(docs, "terms", min_df)
    return known, features.TermCounter(known, "terms", "features").transform(docs)


def limit(monkeypatch, sent):
    monkeypatch.setattr(features, "HEAD", sent)
    monkeypatch.setattr(topics, "SENT", 2 * sent)


def as_table(spark, weights):
    """Weights of a matrix (terms x topics) as a table."""
    return keep(spark.createDataFrame([(i, [float(x) for x in w]) for i, w in enumerate(weights)], "idx long, weights array<double>"))


def test_vocabulary_as_a_table_is_the_same(spark, docs, monkeypatch):
    monkeypatch.setattr(features, "SLICE", 100)
    for df, min_df in ((docs, 1), (docs, 2), (docs.where("false"), 1), (docs.union(docs), 2)):
        known = features.vocabulary_table(df, "terms", min_df)
        assert known.columns == ["term", "idx"]
        assert [r.term for r in known.orderBy("idx").collect()] == features.vocabulary(df, "terms", min_df=min_df)
        assert sorted(r.idx for r in known.collect()) == list(range(known.count()))


@ROUTES
def test_counts_are_those_of_the_library(docs, monkeypatch, sent):
    limit(monkeypatch, sent)
    known, found = counted(docs)
    names = [r.term for r in known.orderBy("idx").collect()]
    model = features.counter(names, "terms", "v")
    want = sorted((r.doc_id, [(int(i), int(n)) for i, n in zip(r.v.indices, r.v.values)]) for r in model.transform(docs).collect())
    got = found.collect()
    assert sorted((r.doc_id, [*zip(r.features.indices, r.features["values"])]) for r in got) == want
    assert {r.features.size for r in got} == {len(names)}
    assert len({r.row for r in got}) == docs.count()


def test_null_lists_and_odd_terms_count(spark):
    odd = spark.createDataFrame([(None,), (["", "\0", "\U0001f600", "", None],), ([""],), ([],)], "terms array<string>")
    known, found = counted(odd, 1)
    assert rows(known) == [("", 0), ("\0", 1), ("\U0001f600", 2)]
    assert sorted([*zip(r.features.indices, r.features["values"])] for r in found.collect()) == [[], [], [(0, 1)], [(0, 2), (1, 1), (2, 1)]]


def test_digamma_and_trigamma():
    x = np.array([1e-3, 0.5, 1.0, 2.0, 7.5, 1e6])
    slope = [(math.lgamma(v * (1 + 1e-5)) - math.lgamma(v * (1 - 1e-5))) / (2e-5 * v) for v in x[:5]]
    assert topics.digamma(x[:5]) == pytest.approx(slope, rel=1e-6)
    assert topics.digamma(np.array([1.0, 0.5])) == pytest.approx([-0.5772156649015329, -1.9635100260214235], rel=1e-10)
    assert topics.trigamma(np.array([1.0, 0.5])) == pytest.approx([math.pi**2 / 6, math.pi**2 / 2], rel=1e-9)
    assert topics.trigamma(x[5:]) == pytest.approx([1 / 1e6 + 0.5 / 1e12], rel=1e-9)


@ROUTES
def test_mixes_are_those_of_the_library(spark, docs, monkeypatch, sent):
    """Given the library's topics and prior, each document gets the library's mix."""
    limit(monkeypatch, sent)
    known, found = counted(docs)
    names = [r.term for r in known.orderBy("idx").collect()]
    vectors = features.counter(names, "terms", "features").transform(docs.withColumn("key", F.concat_ws(" ", "terms")))
    lda = LDA(k=2, maxIter=30, seed=7, subsamplingRate=0.5, learningOffset=10.0).fit(vectors)
    want = {r.key: r.topicDistribution.toArray() for r in lda.transform(vectors).collect()}
    alpha = lda.estimatedDocConcentration().toArray()
    model = topics.TopicModel(as_table(spark, lda.topicsMatrix().toArray()), len(names), alpha, 7, "row")
    keyed = features.TermCounter(known, "terms", "features").transform(docs.withColumn("key", F.concat_ws(" ", "terms")).select("key", "terms"))
    got = model.transform(keyed)
    assert got.columns == ["key", "row", "topicDistribution"]
    got = got.collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.topicDistribution == pytest.approx(want[r.key], abs=0.01), r.key
    top = {r.topic: r for r in model.describeTopics(4).collect()}
    for r in lda.describeTopics(4).collect():
        assert top[r.topic].termIndices == r.termIndices
        assert top[r.topic].termWeights == pytest.approx(r.termWeights)


@ROUTES
def test_every_use_of_a_term_goes_to_the_topics(spark, docs, monkeypatch, sent):
    limit(monkeypatch, sent)
    known, found = counted(docs)
    found = keep(found.withColumn("times", F.expr("int(doc_id % 3)")).where("times > 0"))
    size = known.count()
    draw = np.random.default_rng(1).gamma(100, 0.01, (size, 3))
    model = topics.TopicModel(as_table(spark, draw), size, np.full(3, 1 / 3), 7, "row")
    stats = {r.idx: r.stats for r in model.statistics(found, "times").collect()}
    uses = found.select("times", F.inline(F.arrays_zip("features.indices", "features.values"))).toDF("times", "i", "n")
    want = {r.i: r.n for r in uses.groupBy("i").agg(F.sum(F.expr("times * n")).alias("n")).collect()}
    full = found.where("size(features.indices) > 0").agg(F.sum("times")).first()[0]
    assert stats.pop(topics._DOCS) == [full] * 3
    assert all(x < 0 for x in stats.pop(topics._MIXES))
    assert {i: sum(s) for i, s in stats.items()} == pytest.approx(want)


def test_a_step_moves_topics_and_prior_as_the_library_does(spark, docs, monkeypatch):
    """The formulas, term by term; documents drawn by chance, some of them twice."""
    known, found = counted(docs)
    found, size, number = keep(found), known.count(), docs.count()
    learner = topics.TopicLearner(2, 1, 7, share=0.4, offset=3.0, decay=0.6)
    start = topics.TopicModel(learner._start(spark, size), size, np.full(2, 0.5), 7, "row")
    model = learner.fit(found)
    drawn = found.withColumn("times", learner._times(1))
    times = [r.times for r in drawn.collect()]
    assert 0.25 * number < sum(times) < 0.55 * number and max(times) > 1
    stats = {r.idx: np.array(r.stats) for r in start.statistics(drawn.where("times > 0"), "times").collect()}
    before = {r.idx: np.array(r.weights) for r in start.weights.collect()}
    rate, scale = 4.0**-0.6, number / math.ceil(0.4 * number)
    want = {i: (1 - rate) * w + rate * (scale * stats.get(i, np.zeros(2)) + 0.5) for i, w in before.items()}
    got = {r.idx: np.array(r.weights) for r in model.weights.collect()}
    assert len(got) == size and all(got[i] == pytest.approx(w) for i, w in want.items())
    seen = stats[topics._DOCS][0]
    assert model.alpha == pytest.approx(learner._prior(start.alpha, stats[topics._MIXES] / seen, seen, rate))
    assert (model.alpha != start.alpha).all()
    # starting weights do not depend on how they are dealt out, and have mean 1
    assert abs(np.mean([*before.values()]) - 1) < 0.05


def test_learns_planted_subjects(docs, monkeypatch):
    limit(monkeypatch, 20)
    known, found = counted(docs)
    found = keep(found)
    model = topics.TopicLearner(2, 8, 7, share=0.6, offset=1.0).fit(found)
    names = dict(known.select("idx", "term").collect())
    leading = [{names[i][0] for i in r.termIndices} - {"c"} for r in model.describeTopics(12).collect()]
    assert sorted(map(sorted, leading)) == [["a"], ["b"]]
    mixes = {r.doc_id: r.topicDistribution for r in model.transform(found).collect()}
    for r in docs.where("doc_id >= 50").collect():    # smaller ones come twice
        own = 0 if any(t[0] in leading[0] for t in r.terms) else 1
        assert mixes[r.doc_id][own] > 0.9


def test_documents_without_terms(spark):
    empty = spark.createDataFrame([(1, ["a"]), (2, []), (3, None)], "doc_id int, terms array<string>")
    _, found = counted(empty)
    model = models.topics().fit(found)
    assert rows(model.transform(found).select("doc_id", "topicDistribution")) == [(i, [0.0, 0.0]) for i in (1, 2, 3)]
    assert rows(model.describeTopics(3)) == [(0, [], []), (1, [], [])]
    with pytest.raises(ValueError, match="no documents"):
        models.topics().fit(found.where("false"))


@pytest.mark.parametrize("name", ["ml_lda", "ml_lda_mix"])
def test_no_more_terms_reach_the_driver_than_are_sent(spark, tmp_path, monkeypatch, name):
    """The vocabulary, its counts and its weights stay tables."""
    words = spark.range(4000).select(F.concat(F.lit("w"), F.col("id") % 2000).alias("w"), (F.col("id") % 50).alias("doc_id"))
    texts = words.groupBy("doc_id").agg(F.concat_ws(" ", F.collect_list("w")).alias("text"))
    texts.withColumn("doc_id", F.explode(F.array("doc_id", F.col("doc_id") + 50))).write.parquet(f"{tmp_path}/documents.parquet")
    limit(monkeypatch, 100)
    most = []
    for way in ("collect", "toArrow", "toPandas"):
        def told(self, *a, old=getattr(type(words), way), **b):
            most.append(len(got := old(self, *a, **b)))
            return got
        monkeypatch.setattr(type(words), way, told)
    result = getattr(learning, name)(spark, str(tmp_path))
    assert most and max(most) <= 100
    monkeypatch.undo()
    want = [(i, 3, True) for i in range(2)] if name == "ml_lda" else [(i, 2, True) for i in range(100)]
    assert sorted(tuple(r) for r in result.collect()) == want

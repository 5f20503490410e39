"""Approximate neighbours: recall and scores against brute force, ties and odd vectors."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import neighbours
from millrace.llm.queries import QUERIES


@pytest.fixture
def vectors(spark):
    def make(rows):
        return spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    return make


def run(df, asked, k):
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in neighbours.nearest(df, asked, k).collect()}


def recall(out, ids, data, asked, k=5):
    """Share of the true nearest found; scores must be exact, ranks gapless."""
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    by = {}
    for r in out:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    place = {v: i for i, v in enumerate(ids.tolist())}
    for q in asked:
        cosine = unit @ unit[place[q]]
        cosine[place[q]] = -9
        best = set(ids[np.lexsort((ids, -cosine))[:k]].tolist())
        own = sorted(by[q])
        assert [r[0] for r in own] == list(range(1, k + 1))
        assert all(abs(s - cosine[place[v]]) < 1e-12 for _, v, s in own)
        hits += len(best & {v for _, v, _ in own})
        total += k
    return hits / total


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_and_scores(spark, sf_dir, size):
    folder = sf_dir.replace("sf0.001", size)
    rows = [r for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect() if r.embedding is not None]
    ids = np.array([r.vec_id for r in rows])
    found = recall(QUERIES["op4_kdtree"](spark, folder).collect(), ids, np.array([r.embedding for r in rows], float), ids[ids % 50 == 0])
    assert found >= 0.95


def test_clusters_in_many_cells(spark, vectors, monkeypatch):
    """Queries of a cluster leave the cells of all others alone, and lose nothing by it."""
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 60)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 16)) * 9
    data = np.array([centres[i % 20] + 0.3 * rng.standard_normal(16) for i in range(1200)])
    df = vectors([(i, v.tolist()) for i, v in enumerate(data)])
    out = neighbours.nearest(df, df.where("vec_id % 10 = 3"), 5).collect()
    assert recall(out, np.arange(1200), data, range(3, 1200, 10)) >= 0.95


def test_repeated_ids_are_one_candidate_each(vectors):
    df = vectors([(0, [1.0, 0.0])] + [(7, [1.0, 0.01 * i]) for i in range(6)] + [(20 + i, [1.0, 0.5 + i]) for i in range(6)])
    got = run(df, df.where("vec_id = 0"), 5)
    assert [got[0, r][0] for r in range(1, 6)] == [7, 20, 21, 22, 23]
    assert got[0, 1][1] == 1.0


def test_chi_square_and_its_inverse():
    assert abs(neighbours.chi_square(15.507, 8) - 0.95) < 1e-4
    assert abs(neighbours.stopping_factor(0.95, 8) - 15.507) < 1e-2
    assert neighbours.chi_square(5000, 8) == 1


@pytest.mark.parametrize("points", [np.random.default_rng(1).standard_normal((500, 3)), np.zeros((100, 2)),
                                    np.r_[np.zeros((90, 2)), np.arange(20).reshape(10, 2)], np.ones((1, 2))])
def test_tree_has_every_point_in_its_box(points):
    tree = neighbours.KDTree(points, 16)
    starts = [0, *tree.ends[:-1]]
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    for leaf, (a, b) in enumerate(zip(starts, tree.ends)):
        own = points[tree.order[a:b]]
        assert (tree.leaf_of(own) == leaf).all()
        assert b - a <= 16 or (own == own[0]).all()
        assert (own >= tree.low[leaf]).all() and (own <= tree.high[leaf]).all()
    far = neighbours.box_distances(tree.low, tree.high, points)
    assert (far[np.arange(len(points)), tree.leaf_of(points)] == 0).all()


def test_ties_and_many_equal_vectors(vectors):
    df = vectors([(i, [1.0, 2.0]) for i in range(300)] + [(500, [2.0, 1.0])])
    got = run(df, df.where("vec_id IN (0, 3, 500)"), 5)
    assert [got[0, r][0] for r in range(1, 6)] == [1, 2, 3, 4, 5]
    assert [got[3, r][0] for r in range(1, 6)] == [0, 1, 2, 4, 5]
    assert [got[500, r][0] for r in range(1, 6)] == [0, 1, 2, 3, 4]


def test_odd_vectors_take_no_part(vectors):
    bad = [(1, None), (2, [0.0, 0.0]), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [])]
    good = [(7, [1.0, 0.0]), (8, [1e200, 1e200]), (9, [0.0, -1.0]), (7, [1.0, 0.0]), (10, [1.0, 2.0, 3.0])]
    df = vectors(bad + good).withColumn("query_id", F.lit("clash"))
    got = run(df, df, 5)
    assert {q for q, _ in got} == {7, 8, 9}
    assert [got[7, r][0] for r in (1, 2)] == [8, 9] and (7, 3) not in got
    assert abs(got[7, 1][1] - 0.5 ** 0.5) < 1e-12
    assert run(df.limit(0), df, 5) == {} == run(df, df.limit(0), 5)

"""Whitening against a dense eigendecomposition."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import whitening
from millrace.llm.queries import QUERIES


@pytest.fixture
def vectors(spark):
    def make(rows):
        return spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    return make


def brute(rows, count=4):
    """{vec_id: (deviation, |whitened| per component)}, n, explained shares of the usable rows."""
    good = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.unique(np.array([v for _, v in good]), axis=0)
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(count, int((values > 1e-10 * values.sum()).sum()))
    out = {i: (int(((n * v - s) ** 2).sum()), (v - s / n) @ axes[:, :k] / np.sqrt(values[:k])) for i, v in good}
    return out, n, values[:k] / values.sum()


def compare(got, rows, count=4, tolerance=1e-8):
    want, n, shares = brute(rows, count)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert by.keys() == want.keys()
    signs = None
    for i, (deviation, white) in want.items():
        own = by[i]
        assert sorted(own) == list(range(1, len(shares) + 1))
        y = np.array([own[c].whitened for c in sorted(own)])
        assert all(r.n == n and r.deviation == deviation and r.identity_error <= 1e-9 for r in own.values())
        assert np.allclose([own[c].explained for c in sorted(own)], shares, rtol=1e-10)
        assert np.allclose(np.abs(y), np.abs(white), atol=tolerance)
        if signs is None and (np.abs(white) > 1e-3).all():
            signs = np.sign(y * white)
        if signs is not None:
            assert np.allclose(y * signs, white, atol=tolerance)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_query(spark, sf_dir, size):
    folder = sf_dir.replace("sf0.001", size)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    compare(QUERIES["op11_whitening"](spark, folder).collect(), rows)


def test_odd_vectors(vectors):
    rng = np.random.default_rng(0)
    good = [(i, (rng.standard_normal(5) * [9, 5, 3, 2, 1]).tolist()) for i in range(60)] + [(100, [0.5] * 5), (101, [0.5] * 5), (102, [-0.0, 0.0, -1e-9, 1.0, 2.0])]
    bad = [(200, None), (201, []), (202, [None, 1.0, 1.0, 1.0, 1.0]), (203, [float("nan")] * 5), (204, [float("inf")] * 5), (205, [1.0, 2.0]), (206, [1e300] * 5)]
    df = vectors(good + bad).withColumn("x", F.lit("clash")).withColumn("n", F.lit(0))
    compare(whitening.whiten(df).collect(), good)
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.where("vec_id IN (100, 101)")).collect() == []
    two = whitening.whiten(df.where("vec_id < 2")).collect()
    assert {r.component for r in two} == {1} and all(abs(abs(r.whitened) - 1) < 1e-12 for r in two)
    twice = whitening.whiten(df.unionAll(vectors([(None, good[0][1]), (0, good[0][1])]).selectExpr("*", "'' x", "1 n"))).collect()
    assert sum(r.vec_id is None for r in twice) == 4 and sum(r.vec_id == 0 for r in twice) == 8


def test_repeated_eigenvalues(vectors):
    rows = [(2 * i + s, [0.0] * i + [4.0 if s else -4.0] + [0.0] * (5 - i)) for i in range(6) for s in (0, 1)]
    got = whitening.whiten(vectors(rows)).collect()
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append((r.component, r.whitened))
    y = np.array([[w for _, w in sorted(v)] for v in by.values()])
    assert y.shape == (12, 4) and np.allclose(y.T @ y / 12, np.eye(4), atol=1e-10)
    assert all(abs(r.explained - 1 / 6) < 1e-12 for r in got)


def test_near_and_wide_spectra(vectors):
    rng = np.random.default_rng(3)
    scale = np.r_[[50, 50, 49.99, 49.98], 50 * 0.6 ** np.arange(20)]
    turn = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    rows = [(i, ((rng.standard_normal(24) * scale) @ turn).tolist()) for i in range(400)]
    compare(whitening.whiten(vectors(rows)).collect(), rows, tolerance=1e-7)


def test_exact_deviation():
    x = np.array([[1 << 40, -3], [7, 1 << 30]])
    assert whitening.deviations(x, 1000, [5, 9]) == [None, (7000 - 5) ** 2 + ((1000 << 30) - 9) ** 2 if (1000 << 30) ** 2 < 1 << 63 else None]
    assert whitening.deviations(np.array([[2, 3]]), 4, [1, 1]) == [49 + 121]

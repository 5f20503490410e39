"""Whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Every entry c becomes the integer floor(256 * c).  The fit list, each distinct integer vector once, is
stored in blocks; it is X after its mean is taken from every row.  A step of the bidiagonalisation
multiplies X by a right vector v and X transposed by the resulting left vector u.  One pass does
both: a block forms its rows of p = X v - beta u', the products of p with all earlier left vectors, and
X^T p.  The left vectors are never stored, as each is X times a vector of the embedding's own
length, whose coefficients the driver keeps; so p is made orthogonal to all of them on the driver, and so is X^T u to
all right vectors (full reorthogonalisation on both sides).  What a task returns is one row of
2 d + k numbers, whatever the number of rows.

The singular values of the small bidiagonal matrix are the deviations (times the root of n), its
right singular vectors give the components.  Steps end when the leading ones no longer
move or the matrix is exhausted.  One start vector finds only one vector of a repeated eigenvalue,
so the search starts again orthogonally to what is found, until what it adds is no larger than
the least component kept.

Vectors that are null, empty or hold null or non-finite entries take no part, nor do entries too large
for a 64-bit integer.  If lengths differ, the most frequent length is fitted (of equals the longer) and other
vectors take no part.  Rows that repeat count once in the fit and get one result each; ids may be
null or repeat.  Directions without variance are no components, so a table with fewer than two distinct
vectors gives no rows.  Columns beside id and vector are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.scratch import keep

SCALE = 256
#: Rows that share a block.
BLOCK = 4096
SEED = 11
#: A Ritz value counts as found when its residual falls below this share of the largest one.
RESIDUAL = 1e-13
#: Eigenvalues below this share of the trace are no components.
NEGLIGIBLE = 1e-12


@dataclass
class Fit:
    n: int
    sums: list[int]
    components: np.ndarray      # one a row
    values: np.ndarray          # eigenvalues, falling
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array(self.sums, float) / self.n


def integers(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(__id, x): the usable rows, of one length."""
    limit = float(1 << 54)
    fine = F.forall("__v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < limit))
    rows = (
        vectors.select(F.col(vec_id).alias("__id"), F.col(vector).cast("array<double>").alias("__v"))
        .where(F.col("__v").isNotNull() & (F.size("__v") > 0) & F.coalesce(fine, F.lit(False)))
        .select("__id", F.transform("__v", lambda c: F.floor(c * SCALE).cast("long")).alias("x"))
    )
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("x") == (lengths[0]["d"] if lengths else -1))


def blocks(rows: DataFrame) -> DataFrame:
    """(rows, n): the distinct vectors as bytes of 64-bit integers, ``BLOCK`` a row, stored."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, BLOCK) for i in range(0, batch.num_rows, BLOCK)):
                x = part.column(0)
                flat = x.flatten().to_numpy().astype("<i8")
                yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], pa.binary()), pa.array([part.num_rows], pa.int64())], names=["rows", "n"])

    return keep(rows.select("x").groupBy("x").agg(F.lit(1)).select("x").mapInArrow(pack, "rows binary, n long"), "whitening-blocks")


def totals(stored: DataFrame, work, size: int) -> np.ndarray:
    """Sum over all blocks of ``work(integers of a block)``, an array of ``size`` doubles; the driver
    adds one row a task."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for data, n in zip(batch.column(0), batch.column(1)):
                total += work(np.frombuffer(data.as_buffer(), "<i8").reshape(n.as_py(), -1))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    parts = [np.frombuffer(r["total"]) for r in stored.mapInArrow(each, "total binary").collect()]
    return np.sum(parts, axis=0) if parts else np.zeros(size)


def exact_sums(stored: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and sum of each dimension, exactly: 32-bit halves are added apart."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            for data, rows in zip(batch.column(0), batch.column(1)):
                x = np.frombuffer(data.as_buffer(), "<i8").reshape(rows.as_py(), -1)
                halves = np.array([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
                total = halves if total is None else total + halves
                n += len(x)
        if n:
            yield pa.RecordBatch.from_pylist([{"n": n, "high": total[0].tolist(), "low": total[1].tolist()}])

    rows = stored.mapInArrow(each, "n long, high array<long>, low array<long>").collect()
    width = len(rows[0]["high"]) if rows else 0
    sums = [sum((r["high"][i] << 32) + r["low"][i] for r in rows) for i in range(width)]
    return sum(r["n"] for r in rows), sums


def bidiagonalised(products, d: int, count: int, found: np.ndarray, rng: np.random.Generator, exhausted: float) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (one a row) and singular values of the leading ``count``, of X
    restricted to what is orthogonal to the rows of ``found``.

    ``products(z, W)`` gives, for p = X z, the products of p with each column of X W, p with
    itself, and X^T p."""
    def clear(x: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
        for _ in range(2):
            for basis in (found, np.array(against).reshape(-1, d)):
                x = x - basis.T @ (basis @ x)
        return x

    v = clear(rng.standard_normal(d), [])
    if not np.linalg.norm(v):
        return np.zeros((0, d)), np.zeros(0)
    v /= np.linalg.norm(v)
    right, left, seen = [], [], []      # left: coefficients w of u = X w; seen: X^T u
    alphas, betas, beta = [], [], 0.0
    while True:
        right.append(v)
        z = v - beta * left[-1] if left else v
        inner, square, back = products(z, np.array(left).reshape(-1, d).T)
        # u = p - sum of (p, u_i) u_i; its X^T u follows from those at hand
        alpha = float(np.sqrt(max(square - inner @ inner, 0.0)))
        if alpha <= exhausted:
            break       # X v is beta u': the last column has no alpha
        w = (z - (np.array(left).T @ inner if left else 0)) / alpha
        back = (back - (np.array(seen).T @ inner if seen else 0)) / alpha
        alphas.append(alpha)
        left.append(w)
        seen.append(back)
        v = clear(back - alpha * right[-1], right)
        beta = float(np.linalg.norm(v))
        small = np.diag(alphas) + np.diag(betas, 1)
        p, sigma, _ = np.linalg.svd(small)
        residual = beta * np.abs(p[-1, :count])
        if beta <= exhausted or len(right) + len(found) >= d or (len(right) >= count and (residual <= RESIDUAL * sigma[0]).all()):
            break
        betas.append(beta)
        v /= beta
    if not alphas:
        return np.zeros((0, d)), np.zeros(0)
    k = len(alphas)
    small = np.zeros((k, len(right)))
    small[range(k), range(k)] = alphas
    small[range(len(right) - 1), range(1, len(right))] = betas[:len(right) - 1]
    _, sigma, q = np.linalg.svd(small)
    return q[:min(count, k)] @ np.array(right), sigma[:count]


def fit(stored: DataFrame, count: int) -> Fit | None:
    """Of the distinct integer vectors in ``blocks``; None without any."""
    n, sums = exact_sums(stored)
    if not n:
        return None
    d, mean = len(sums), np.array([s / n for s in sums])
    trace = float(totals(stored, lambda x: ((x - mean) ** 2).sum(), 1)[0]) / n

    def products(z: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        k = w.shape[1]

        def work(x: np.ndarray) -> np.ndarray:
            rows = x - mean
            p = rows @ z
            return np.concatenate([(rows @ w).T @ p, [p @ p], rows.T @ p])

        got = totals(stored, work, k + 1 + d)
        return got[:k], float(got[k]), got[k + 1:]

    rng = np.random.default_rng(SEED)
    exhausted = float(np.sqrt(NEGLIGIBLE * trace * n))
    vectors, sigma = np.zeros((0, d)), np.zeros(0)
    while trace > 0 and len(vectors) < d:
        new, s = bidiagonalised(products, d, count if not len(vectors) else 1, vectors, rng, exhausted)
        if not len(s) or (len(sigma) >= count and s[0] <= sigma[count - 1]):
            break
        vectors, sigma = np.vstack([vectors, new]), np.append(sigma, s)
        order = np.argsort(-sigma, kind="stable")
        vectors, sigma = vectors[order], sigma[order]
    vectors, values = vectors[:count], sigma[:count] ** 2 / n
    vectors, values = vectors[values > NEGLIGIBLE * trace], values[values > NEGLIGIBLE * trace]
    k = len(values)

    def whitened(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ vectors.T / np.sqrt(values)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    error = 0.0
    if k:
        got = totals(stored, whitened, k + k * k)
        average = got[:k] / n
        error = float(np.abs(got[k:].reshape(k, k) / n - np.outer(average, average) - np.eye(k)).max())
    return Fit(n, sums, vectors, values, trace, error)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exactly; None where it fits no long."""
    most = max(abs(int(x.max())), abs(int(x.min()))) * n + max(map(abs, sums))
    if most * most * x.shape[1] < 1 << 63:
        own = x * n - np.array(sums, np.int64)
        return (own * own).sum(axis=1).tolist()
    own = x.astype(object) * n - np.array(sums, object)
    return [s if s < 1 << 63 else None for s in (own * own).sum(axis=1).tolist()]


def whiten(vectors: DataFrame, count: int = 4, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each
    usable row of ``vectors`` and each component."""
    rows = integers(vectors, vec_id, vector)
    spec = T.StructType([T.StructField(vec_id, rows.schema["__id"].dataType), *T.StructType.fromDDL(
        "component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    model = fit(blocks(rows), count)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, m = len(model.values), batch.num_rows
            if not (k and m):
                continue
            x = batch.column(1).flatten().to_numpy().reshape(m, -1)
            y = (x - model.mean) @ model.components.T / np.sqrt(model.values)
            twice = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(twice)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(twice)), pa.array(y.ravel()),
                pa.array(np.tile(model.values / model.trace, m)), pa.array(np.full(m * k, model.identity_error))], names=spec.names)

    if model is None:
        return vectors.sparkSession.createDataFrame([], spec)
    return rows.mapInArrow(project, spec)

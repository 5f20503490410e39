"""Models per group whose groups may be larger than a task's memory.

A group reaches Python as a stream of batches; of all batches seen a task keeps one small
triangle, the R of a QR decomposition of the rows so far.  Triangles of parts of a group stack into the
triangle of the whole, so a large group is also dealt out over ``salts`` tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _triangle(rows: np.ndarray, so_far: np.ndarray | None) -> np.ndarray:
    stacked = rows if so_far is None else np.vstack([so_far, rows])
    r = np.linalg.qr(stacked, mode="r")
    full = np.zeros((stacked.shape[1], stacked.shape[1]))
    full[:len(r)] = r
    return full


def _solved(r: np.ndarray, n: int) -> dict:
    """Least squares from the triangle of (1, features, label): the rows below the first are about the means."""
    d = len(r) - 2
    w = np.linalg.lstsq(r[:d + 1, :d + 1], r[:d + 1, d + 1], rcond=None)[0]
    total = float((r[1:, -1] ** 2).sum())
    missed = float(((r[:, :-1] @ w - r[:, -1]) ** 2).sum())
    return {"coefficients": w[1:].tolist(), "intercept": float(w[0]), "r2": 1 - missed / total if total > 0 else None, "n": n}


def fit_streamed(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str, salts: int = 16) -> DataFrame:
    """Least squares per group: keys, ``coefficients``, ``intercept``, ``r2``, ``n``.

    By orthogonal triangles, which lose half as many digits as sums of products do.  Rows with a null feature
    or label drop out; null keys are a group.  Columns that say the same share a solution of least norm.
    """
    used = df.na.drop(subset=[*features, label])
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).alias("__part")
    rows = used.select(*keys, part, F.array(F.lit(1.0), *[F.col(c).cast("double") for c in (*features, label)]).alias("__row"))
    names = T.StructType([df.schema[k] for k in keys])
    width = len(features) + 2
    partial = T.StructType([*names.fields, T.StructField("n", T.LongType()), T.StructField("r", T.ArrayType(T.DoubleType()))])
    final = T.StructType([*names.fields, *T.StructType.fromDDL("coefficients array<double>, intercept double, r2 double, n long").fields])

    def own(key: tuple) -> dict:
        return {k: pa.array([v.as_py()], v.type) for k, v in zip(keys, key)}

    def triangles(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, r = 0, None
        for batch in batches:
            values = batch.column("__row").flatten().to_numpy().reshape(-1, width)
            for at in range(0, len(values), 4096):
                r = _triangle(values[at:at + 4096], r)
            n += len(values)
        if n:
            yield pa.record_batch({**own(key), "n": pa.array([n], pa.int64()), "r": pa.array([r.ravel()], pa.list_(pa.float64()))})

    def solve(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, r = 0, None
        for batch in batches:
            for rows_of, flat in zip(batch.column("n").to_pylist(), batch.column("r").to_pylist()):
                n, r = n + rows_of, _triangle(np.array(flat).reshape(width, width), r)
        if n:
            found = _solved(r, n)
            yield pa.record_batch({**own(key), "coefficients": pa.array([found["coefficients"]], pa.list_(pa.float64())),
                                   "intercept": pa.array([found["intercept"]], pa.float64()), "r2": pa.array([found["r2"]], pa.float64()),
                                   "n": pa.array([n], pa.int64())})

    parts = rows.groupBy(*keys, "__part").applyInArrow(triangles, partial)
    return parts.groupBy(*keys).applyInArrow(solve, final)

"""Scoring with models from elsewhere, per-group fits, saved models."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score_column(predict: Callable[[np.ndarray], np.ndarray], columns: Sequence[str]) -> Column:
    """A model that takes a matrix and returns a vector, as a column over ``columns``.

    The model travels with the function to each worker once and sees Arrow batches.
    """
    names = list(columns)

    @F.pandas_udf("double")
    def score(batch: pd.DataFrame) -> pd.Series:
        return pd.Series(predict(batch[names].to_numpy(dtype=float)))

    return score(F.struct(*names))


def linear_model(weights: Sequence[float], intercept: float) -> Callable[[np.ndarray], np.ndarray]:
    w = np.asarray(weights, dtype=float)

    def predict(x: np.ndarray) -> np.ndarray:
        return x @ w + intercept

    return predict


def fit_per_group(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str
) -> DataFrame:
    """Least squares per group: keys, ``coefficients`` (array), ``intercept``, ``n``.

    The sums of products are ordinary aggregates, combined in every task, so a
    group of any size is fitted without being gathered; only the small system
    of equations (one row per group) is solved in Python.
    """
    k = len(features)
    used = df.na.drop(subset=[*features, label])
    x = [F.col(f).cast("double") for f in features]
    y = F.col(label).cast("double")
    sums = [F.sum(x[i] * x[j]) for i in range(k) for j in range(i, k)]
    moments = used.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(c) for c in x]).alias("sx"),
        F.sum(y).alias("sy"),
        F.array(*sums).alias("sxx"),
        F.array(*[F.sum(c * y) for c in x]).alias("sxy"),
    )

    @F.pandas_udf("array<double>")
    def solve(n: pd.Series, sx: pd.Series, sy: pd.Series, sxx: pd.Series, sxy: pd.Series
              ) -> pd.Series:
        out = []
        upper = np.triu_indices(k)
        for rows, a, b, c, d in zip(n, sx, sy, sxx, sxy):
            gram = np.empty((k, k))
            gram[upper] = c
            gram.T[upper] = c
            mean_x, mean_y = np.asarray(a) / rows, b / rows
            left = gram - rows * np.outer(mean_x, mean_x)
            right = np.asarray(d) - rows * mean_x * mean_y
            w = np.linalg.lstsq(left, right, rcond=None)[0]
            out.append([*w, mean_y - float(mean_x @ w)])
        return pd.Series(out)

    solved = moments.withColumn("__w", solve("n", "sx", "sy", "sxx", "sxy"))
    return solved.select(
        *keys,
        F.slice("__w", 1, k).alias("coefficients"),
        F.element_at("__w", k + 1).alias("intercept"),
        "n",
    )


def save_model(model, path: str) -> None:
    """Save a fitted pipeline (or stage), replacing what is there."""
    pipeline = model if isinstance(model, PipelineModel) else PipelineModel([model])
    pipeline.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_table(model, rows: DataFrame, path: str, mode: str = "error") -> DataFrame:
    """Predict for a whole table, write it, return the written rows."""
    scored = model.transform(rows)
    plain = [f.name for f in scored.schema.fields if not isinstance(f.dataType, VectorUDT)]
    scored.select(*plain).write.mode(mode).parquet(path)
    return rows.sparkSession.read.schema(scored.select(*plain).schema).parquet(path)

"""Filters that need an aggregate of the data they filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def at_global_max(df: DataFrame, column: str) -> DataFrame:
    """All rows that hold the largest value; ties stay, nulls never qualify.

    The maximum is a scalar subquery, so nothing passes through the driver and
    its value is pushed into the scan.
    """
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


def keys_with_count_above(
    df: DataFrame, keys: Sequence[str], bound: int, name: str = "n"
) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name)).where(F.col(name) > bound)

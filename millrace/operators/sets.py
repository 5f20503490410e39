"""Unions and the view that serves batch and fresh rows together."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_by_position(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by place; names come from ``first``; duplicates stay."""
    out = first
    for other in others:
        if len(other.columns) != len(first.columns):
            raise ValueError("frames differ in their number of columns")
        out = out.union(other)
    return out


def serving_view(
    batch: DataFrame, speed: DataFrame, name: str, drop: tuple[str, ...] = ()
) -> DataFrame:
    """Global view over the batch table and the speed table without its event columns."""
    union_by_position(batch, speed.drop(*drop)).createOrReplaceGlobalTempView(name)
    return batch.sparkSession.table(f"global_temp.{name}")

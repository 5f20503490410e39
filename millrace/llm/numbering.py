"""Gapless numbers within keys of any size, without one task per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a key that share a window, on average.
BUCKET_ROWS = 20_000


def numbered(df: DataFrame, key: str, unique: str, out: str, rows: int) -> DataFrame:
    """``df`` with ``out``: 0, 1, ... within ``key``, in an order given by ``unique``.

    Rows are numbered inside hash buckets of a key, and each bucket's first number is the
    count of the rows in the buckets before it.  ``df`` must be stored, as it is read twice;
    ``rows`` is its row count.
    """
    buckets = rows // BUCKET_ROWS + 1
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(unique), F.lit(buckets)))
    sizes = dealt.groupBy(key, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(key).alias("__key"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    own = F.row_number().over(Window.partitionBy(key, "__bucket").orderBy(unique))
    return (
        dealt.withColumn(out, own.cast("long"))
        .join(starts, (F.col(key) == F.col("__key")) & (F.col("__bucket") == F.col("__b")))
        .select(*df.columns, (F.col(out) + F.col("__start") - 1).alias(out))
    )

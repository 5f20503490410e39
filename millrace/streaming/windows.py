"""Sliding windows over event time, for streams and for tables alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sliding_activity(
    df: DataFrame,
    time: str,
    key: str,
    size: str = "30 seconds",
    slide: str = "10 seconds",
    start: str = "0 seconds",
    delay: str | None = "1 minute",
) -> DataFrame:
    """Latest time and number of rows per key and window [start, end).

    ``time`` must be a timestamp.  ``delay`` is the watermark: on a stream, rows
    later than that may be dropped and a window leaves the state once it has
    passed.  Rows are combined per task before they reach the state store, so a
    key that dominates the input sends one row per task and window.
    """
    if delay is not None:
        df = df.withWatermark(time, delay)
    window = F.window(time, size, slide, start)
    return (
        df.groupBy(window.alias("window"), key)
        .agg(F.max(time).alias("last_time"), F.count(key).alias("n"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            key, "last_time", "n",
        )
    )


def naive_times(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as wall-clock times of the session's zone."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})

"""Raw, parsed, aggregated: three tables, each fed by a stream over the one before."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.parsing import to_time
from millrace.streaming import runs
from millrace.streaming.windows import sliding_activity


@dataclass(frozen=True)
class HopPaths:
    """Folders of the pipeline; tables and checkpoints never share one."""

    root: str

    def table(self, hop: str) -> str:
        return f"{self.root}/{hop}"

    def checkpoint(self, hop: str) -> str:
        return f"{self.root}/checkpoints/{hop}"


def run_hops(
    spark: SparkSession,
    raw: DataFrame,
    paths: HopPaths,
    time_text: str,
    key: str,
    pattern: str = "dd/M/yy HH:mm",
    size: str = "30 seconds",
    slide: str = "10 seconds",
    delay: str = "1 minute",
    once: bool = True,
) -> DataFrame:
    """Run the hops and return the aggregated table.

    ``raw`` is a stream whose column ``time_text`` holds times as text; rows with
    unreadable times stay in the raw and parsed tables and leave the windows.
    """
    runs.to_parquet(raw, paths.table("raw"), paths.checkpoint("raw"), once)

    parsed = (
        spark.readStream.schema(raw.schema)
        .parquet(paths.table("raw"))
        .withColumn("event_time", to_time(time_text, pattern))
    )
    runs.to_parquet(parsed, paths.table("parsed"), paths.checkpoint("parsed"), once)

    timed = (
        spark.readStream.schema(parsed.schema)
        .parquet(paths.table("parsed"))
        .where(F.col("event_time").isNotNull())
    )
    activity = sliding_activity(timed, "event_time", key, size, slide, delay=delay)
    runs.to_parquet(activity, paths.table("activity"), paths.checkpoint("activity"), once)
    return spark.read.schema(activity.schema).parquet(paths.table("activity"))

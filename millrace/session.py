"""One place that builds the session used by the bench, the tests and jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings every job here relies on.  ANSI mode is left on: casts that
# may fail are written as try_cast in the operators.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Window state larger than executor memory lives in RocksDB, not on heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "millrace",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Session with the defaults above.

    ``master`` and ``shuffle_partitions`` stay unset on a cluster, where the
    submit command chooses them; extra settings use ``__`` for ``.``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()

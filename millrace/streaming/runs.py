"""Starting streams.  Every run has its own checkpoint in the shared folder, never
inside the table it writes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from millrace import scratch


#: Arbitrary state needs a store with several column families, which Spark's default one has not.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextmanager
def _settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """A stream takes a copy of the session's settings when it starts; afterwards they are as before."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _start(writer: DataStreamWriter, wait: bool) -> StreamingQuery:
    query = writer.start()
    if wait:
        query.awaitTermination()
    return query


def _triggered(writer: DataStreamWriter, once: bool, every: str | None) -> DataStreamWriter:
    if once:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def to_parquet(
    stream: DataFrame, path: str, checkpoint: str, once: bool = True,
    every: str | None = None, partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append files exactly once.  ``once`` works off the backlog and stops; otherwise
    the stream runs on, in micro-batches ``every`` so often."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(_triggered(writer, once, every), wait=once)


def to_batches(
    stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
    mode: str = "update", once: bool = True, every: str | None = None, conf: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Call ``fn(batch, batch_id)`` per micro-batch; a replay repeats the id.  ``conf``: settings of this
    stream alone."""
    writer = (
        stream.writeStream.foreachBatch(fn)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    with _settings(stream.sparkSession, conf or {}):
        query = _start(_triggered(writer, once, every), wait=False)
    if once:
        query.awaitTermination()
    return query


def to_memory(stream: DataFrame, name: str, mode: str = "complete", once: bool = True
              ) -> StreamingQuery:
    """Named in-memory table on the driver, rewritten whole at each trigger.

    For results of a few thousand rows (a board of totals per type), as complete
    mode keeps all state and resends all of it.
    """
    writer = stream.writeStream.format("memory").queryName(name).outputMode(mode)
    return _start(_triggered(writer, once, None), wait=once)


def to_state(stream: DataFrame, checkpoint: str, once: bool = True, every: str | None = None) -> StreamingQuery:
    """Run an aggregation for its state alone: the result is the state, and ``state_rows`` reads
    it.  A trigger touches the groups that changed and sends nothing anywhere, however many
    groups there are."""
    writer = stream.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
    return _start(_triggered(writer, once, every), wait=once)


def state_rows(spark: SparkSession, checkpoint: str, values: Sequence[str], batch: int | None = None) -> DataFrame:
    """All groups of a stream's aggregation as a table, as of its last batch or of ``batch``; each task reads
    one partition of the state.

    ``values`` names what the state holds of each group, in the order of the aggregates: one column for a
    count, sum, minimum or maximum, two (sum, count) for an average.
    """
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(checkpoint)
    held = state.schema["value"].dataType.fields
    if len(held) != len(values):
        raise ValueError(f"the state holds {len(held)} columns: {', '.join(f.name for f in held)}")
    # aggregates of one kind share a name, so names go by position
    named = T.StructType([T.StructField(n, f.dataType) for n, f in zip(values, held)])
    return state.select("key.*", F.col("value").cast(named).alias("value")).select(*[f"`{k.name}`" for k in state.schema["key"].dataType.fields], "value.*")


def new_checkpoint(stream: DataFrame, label: str = "stream") -> str:
    return scratch.new_path(stream.sparkSession, f"{label}-checkpoint")

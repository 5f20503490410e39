"""Streams that write versioned tables: appended batches and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.aggregates import dedupe
from millrace.operators.versioned import VersionedTable
from millrace.streaming.runs import to_batches


def run_id(batch: DataFrame) -> str:
    """Identity of the stream that a micro-batch belongs to.  It is drawn when the checkpoint
    is made and stored there: a restart keeps it, another checkpoint has another one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def append_stream(
    stream: DataFrame, target: VersionedTable, checkpoint: str,
    once: bool = True, every: str | None = None,
) -> StreamingQuery:
    """Append every micro-batch to a table that also has batch rows.

    The stream's identity and the batch id are committed with the rows, so a replayed batch
    adds nothing and a second stream loses nothing.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        target.append(batch, source=run_id(batch), batch_id=batch_id)

    return to_batches(stream, add, checkpoint, mode="append", once=once, every=every)


def upsert_stream(
    stream: DataFrame,
    target: VersionedTable,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    once: bool = True,
    every: str | None = None,
) -> StreamingQuery:
    """Change data capture: per micro-batch keep the last row of each key, then merge."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        target.merge(
            dedupe(batch, keys, order, keep="last"), keys, source=run_id(batch), batch_id=batch_id
        )

    return to_batches(stream, upsert, checkpoint, mode="update", once=once, every=every)

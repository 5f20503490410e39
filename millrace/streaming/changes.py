"""Change data capture in which changes may come in any order, over any number of batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from millrace.operators.versioned import VersionedTable
from millrace.scratch import keep
from millrace.streaming.runs import ROCKSDB, to_batches
from millrace.streaming.tables import run_id


def _newest_only(schema: T.StructType, place: Sequence[str], forgets: bool) -> StatefulProcessor:
    """The class is local so that it is sent by value: the process in which Spark starts it beside the
    driver does not see the modules that only the driver's own path has."""

    class NewestOnly(StatefulProcessor):
        """Per key, passes on the batch's newest change if it is newer than all before, and keeps no
        more than its place.  With ``forgets`` a timer clears the place once the watermark has
        passed it: every change that can still come is newer."""

        def __init__(self, schema: T.StructType, place: Sequence[str], forgets: bool):
            self.columns, self.places, self.forgets = schema.names, tuple(place), forgets
            self.state = T.StructType([schema[c] for c in place])

        def place(self, row: Row) -> tuple:
            return tuple(row[c] for c in self.places)

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.newest = handle.getValueState("newest", self.state)

        def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
            best = max(rows, key=self.place, default=None)
            if best is None:
                return
            place = self.place(best)
            known = self.newest.get() if self.newest.exists() else None
            if known is not None and place <= tuple(known):
                return
            self.newest.update(place)
            if self.forgets:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(place[0] // 1000 + 1)
            yield Row(**{c: best[c] for c in self.columns})

        def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
            self.newest.clear()
            return iter([])

    return NewestOnly(schema, place, forgets)


def _comparable(column: str, kind: T.DataType) -> Column:
    """Times as whole numbers, which workers and state hold alike in any zone."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.unix_date(column) if isinstance(kind, T.DateType) else F.col(column)


def newest_changes(stream: DataFrame, keys: Sequence[str], order: Sequence[str], delay: str | None = None) -> DataFrame:
    """Of a stream of changes those that are newer than all earlier ones of their key, at most one a
    key and batch.  Equal places: the one that came first stays.  A change with a null in
    ``order`` has no place and drops out.

    State is one place per key.  With ``delay``, ``order`` begins with a timestamp; a change
    that comes more than that later than the newest one of the stream drops, and a key's place is forgotten
    once no older change of it can come.
    """
    names = [f"__place{i}" for i in range(len(order))]
    placed = stream.na.drop(subset=list(order)).withColumns({n: _comparable(c, stream.schema[c].dataType) for n, c in zip(names, order)})
    if delay is not None:
        placed = placed.withWatermark(order[0], delay)
    newest = placed.groupBy(*keys).transformWithState(
        _newest_only(placed.schema, names, delay is not None), placed.schema, "Update", "None" if delay is None else "EventTime")
    return newest.drop(*names)


def apply_changes(
    stream: DataFrame, target: VersionedTable, keys: Sequence[str], order: Sequence[str], checkpoint: str,
    delay: str | None = None, once: bool = True, every: str | None = None,
) -> StreamingQuery:
    """Merge a stream of changes so that a key's row is its newest change, however they are dealt
    out to batches.  A batch that is run again after a loss merges the same rows or, if it was
    committed, nothing."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # stored, so that one batch goes through the state once, however often the merge reads it
        target.merge(keep(batch, "newest"), keys, source=run_id(batch), batch_id=batch_id)

    return to_batches(newest_changes(stream, keys, order, delay), upsert, checkpoint, mode="update", once=once, every=every, conf=ROCKSDB)

"""Packing along a space-filling curve: documents that are alike share a sequence.

A document's ids are hashed into a vector of ``BUCKETS`` counts, damped and scaled to length one,
which ``DIMENSIONS`` fixed Gaussian directions project to few coordinates.  Their cell in a grid of
``2**BITS`` steps a side has a Hilbert index; documents are sorted by it over the whole cluster (equal
indices by a hash of the row, so that a hot one spans many ranges), and laid one behind the other along the curve.
Every ``capacity`` tokens a sequence ends, and a document that crosses the end goes on in the
next one.  Only what is left at the very end fills no sequence; it is cut into runs whose lengths
are falling powers of two (one for each binary digit), which need no padding.

Only the places travel through the sort: 4 numbers a document.  The ids are stored once (two bytes
an id if the vocabulary allows) and meet their place in one join.

A null text counts as empty; an empty one has the end id alone.  Rows that repeat, with or without
an id, are packed each by itself.  An empty table gives no pieces.  Columns beside id and text are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.vocabularies import ByteBPE, contents
from millrace.scratch import keep

BUCKETS = 1024
DIMENSIONS = 4
BITS = 15
#: Coordinates are clipped to this far from zero: four standard deviations.
REACH = 4.0
SEED = 12
#: Bytes of text that are encoded before their rows are handed on.
SLICE = 1 << 20
_ROW_BITS = 33


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of non-negative integers below ``2**bits``; rows times bits are at
    most 62.  By Skilling's transform: the rotations and reflections of each level are undone from
    the top bit down, then the Gray code."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = np.int64(1 << level), np.int64((1 << level) - 1)
        for i in range(n):
            set_ = (x[i] & bit) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> level) & 1, np.int64((1 << level) - 1), 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> level) & 1)
    return out


def directions(buckets: int = BUCKETS, dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((buckets, dimensions))


def coordinates(ids: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """A document's place: its hashed, damped and scaled counts, projected."""
    buckets = len(axes)
    hashed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    counts = np.bincount((hashed % np.uint64(buckets)).astype(np.int64), minlength=buckets)
    used = np.flatnonzero(counts)
    damped = np.log1p(counts[used])
    return (damped / max(float(np.sqrt((damped * damped).sum())), 1e-300)) @ axes[used]


def cells(places: np.ndarray, bits: int = BITS) -> np.ndarray:
    steps = np.floor((places + REACH) / (2 * REACH) * (1 << bits)).astype(np.int64)
    return np.clip(steps, 0, (1 << bits) - 1)


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // SLICE)) + 1).tolist(), len(size)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def encoded(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, special: dict[str, int], end_id: int,
            doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(__row, __id, n, curve, ids) of each document, stored; ids as little-endian integers of
    two or four bytes."""
    file = spark.sparkContext.broadcast(contents(ranks_path))
    own = docs.select(F.col(doc_id).alias("__id"), F.coalesce(text, F.lit("")).alias("__text"))
    spec = T.StructType([T.StructField("__id", own.schema["__id"].dataType), *T.StructType.fromDDL("n long, curve long, ids binary").fields])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, axes = ByteBPE(file.value, pattern, special), directions()
        kind = "<u2" if max(vocabulary.size - 1, end_id) < 1 << 16 else "<u4"
        for batch in _slices(batches, "__text"):
            ids = [vocabulary.encode(t.as_py()) for t in batch.column(1)]
            curve = hilbert(cells(np.array([coordinates(x, axes) for x in ids])), BITS)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(x) + 1 for x in ids], pa.int64()), pa.array(curve, pa.int64()),
                pa.array([np.append(x, end_id).astype(kind).tobytes() for x in ids], pa.binary())], names=spec.names)

    return keep(own.mapInArrow(encode, spec).withColumn("__row", F.monotonically_increasing_id()), "packing-ids")


def placed(rows: DataFrame) -> DataFrame:
    """(__row, start): how many tokens lie before each document along the curve.

    Rows are range-sorted and stored; a range's total is one row, so the window over all ranges
    sees as many rows as there were tasks."""
    tie = F.xxhash64("__row")
    along = rows.select("__row", "n", "curve").withColumn("tie", tie).repartitionByRange("curve", "tie").sortWithinPartitions("curve", "tie")
    stored = keep(along.withColumn("range", F.shiftright(F.monotonically_increasing_id(), _ROW_BITS)), "packing-order")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = stored.groupBy("range").agg(F.sum("n").alias("total")).select("range", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("range").orderBy("curve", "tie", "__row").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return stored.withColumn("inside", inside - F.col("n")).join(F.broadcast(ranges), "range").select("__row", (F.col("inside") + F.col("before")).alias("start"))


def rest(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, sequence) of the runs behind the last full sequence, falling powers of two."""
    at, sequence = total - total % capacity, total // capacity
    out = []
    for power in range(capacity.bit_length(), -1, -1):
        if total % capacity >> power & 1:
            out.append((at, sequence))
            at, sequence = at + (1 << power), sequence + 1
    return out


def pieces_of(start: int, n: int, capacity: int, tail: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(ids before, length, sequence, offset there) of a document of ``n`` ids whose first lies at ``start``."""
    ends = [*(s for s, _ in tail), 1 << 62]
    out, at = [], start
    while at < start + n:
        if tail and at >= tail[0][0]:
            k = next(i for i in range(len(tail)) if at < ends[i + 1])
            begin, sequence, end = tail[k][0], tail[k][1], ends[k + 1]
        else:
            sequence = at // capacity
            begin, end = sequence * capacity, (sequence + 1) * capacity
        stop = min(end, start + n)
        out.append((at - start, stop - at, sequence, at - begin))
        at = stop
    return out


def pack(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, special: dict[str, int], end_id: int, capacity: int = 2048,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset of each piece; ``ids`` as
    little-endian unsigned 32-bit integers."""
    rows = encoded(spark, docs, ranks_path, pattern, special, end_id, doc_id, text)
    tail = rest(rows.agg(F.sum("n").alias("n")).first()["n"] or 0, capacity)
    spec = T.StructType([T.StructField(doc_id, rows.schema["__id"].dataType), *T.StructType.fromDDL(
        "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long").fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # some hundred documents at a time: their ids are held twice
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                of, found, ids = [], [], []
                for i, (n, start, data) in enumerate(zip(*(part.column(c).to_pylist() for c in (1, 2, 3)))):
                    own = np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4")
                    for piece in pieces_of(start, n, capacity, tail):
                        of.append(i)
                        found.append((piece[0], piece[1], n, piece[2], piece[3]))
                        ids.append(own[piece[0]:piece[0] + piece[1]].tobytes())
                before, length, n, sequence, offset = (pa.array(c, pa.int64()) for c in (zip(*found) if found else [()] * 5))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(of, pa.int64())), before, length, pa.array(ids, pa.binary()), n, sequence, offset], names=spec.names)

    return rows.join(placed(rows), "__row").select("__id", "n", "start", "ids").mapInArrow(cut, spec)

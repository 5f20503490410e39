"""SimHash near-duplicates: fingerprints of word shingles, links by BK-trees, components.

Contract of the fingerprint: A-Z lower-cased, words between white space of ASCII, shingles
of three words (fewer words: the whole sequence; none, or a null text: fingerprint zero,
linked like any other), repeats count; a bit is set if it is set in over half of the
shingles' XXH64 (seed 42).  Fingerprints link at ``RADIUS`` or fewer differing bits.

Rows with equal fingerprints are one node from the start, so a group of copies of any size
costs one node.  Two fingerprints within the radius of 3 differ in at most 3 of 5 blocks of
bits, so they agree on two whole blocks: each of the 10 pairs of blocks deals the nodes out by
the value of those blocks, and every such shard gets a BK-tree of its own.  A shard hands out
what joins its trees, at most one link a node, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.memory import returning
from millrace.scratch import keep

SEED = 42
WORDS = 3
RADIUS = 3
#: Bit ranges of the blocks: [0, 12), [12, 25), ...
EDGES = (0, 12, 25, 38, 51, 64)
MASKS = tuple(
    sum(((1 << EDGES[b + 1]) - 1) & ~((1 << EDGES[b]) - 1) for b in pair)
    for pair in combinations(range(5), 2)
)


def _hashes(text: str | None, size: int = WORDS) -> np.ndarray:
    """Hashes of a text's shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    h = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([h(line, SEED)], np.uint64)
    return np.array([h(line[a:b], SEED) for a, b in zip(starts, ends[size - 1:])], np.uint64)


def _majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None) -> int:
    """Unsigned fingerprint of a text."""
    return _majority(_hashes(text))


def fingerprints(text: Column) -> Column:
    """Fingerprint as a signed 64-bit integer of the same bits."""
    @returning
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(np.array([fingerprint(t.as_py()) for t in batch], np.uint64).view(np.int64))

    return F.arrow_udf(of, "long")(text)


class BKTree:
    """Integers by Hamming distance: a node's child of key d, and all below it, differ from
    the node in d bits, so a search within r follows the keys d - r to d + r only."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        """Place of the value, which is new or already there."""
        at = 0
        while at < len(self.values):
            d = (self.values[at] ^ value).bit_count()
            if not d:
                return at
            if (child := self.children[at].get(d)) is None:
                self.children[at][d] = len(self.values)
                break
            at = child
        self.values.append(value)
        self.children.append({})
        return len(self.values) - 1

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Places of the values within the radius."""
        todo = [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                yield at
            todo += [c for key, c in self.children[at].items() if d - radius <= key <= d + radius]


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join the values into the components their distances make: a spanning
    forest, at most one link a value.  A search ends once a value is joined to all components
    there are, so a large group of near copies costs no more than its size."""
    tree, root, out, parts = BKTree(), [], [], 0

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for value in values:
        near: dict[int, int] = {}  # component -> a node of it within the radius
        for at in tree.within(value, radius):
            near.setdefault(top(at), at)
            if len(near) == parts:
                break
        own = tree.add(value)
        if own < len(root):
            continue  # the same value again
        root.append(own)
        for part, at in near.items():
            root[part] = own
            out.append((tree.values[at], value))
        parts += 1 - len(near)
    return out


def shards(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[np.ndarray]:
    """The columns' values of each run of rows that agree in ``pair`` and ``key``, from sorted
    batches; runs of one row are left out."""
    rest = np.empty((len(columns), 0), np.int64)
    for batch in (*batches, None):
        if batch is not None:
            rest = np.concatenate([rest, np.stack([batch.column(k).to_numpy().astype(np.int64) for k in columns])], axis=1)
            if not rest.shape[1]:
                continue
        new = np.flatnonzero((np.diff(rest[0]) != 0) | (np.diff(rest[1]) != 0)) + 1
        cuts = np.r_[0, new, rest.shape[1]]
        if batch is not None:
            cuts = cuts[:-1]  # the last run may go on in the next batch
        for i in np.flatnonzero(np.diff(cuts) > 1):
            yield rest[:, cuts[i]:cuts[i + 1]]
        rest = rest[:, cuts[-1]:]


def links(nodes: DataFrame, fp: str = "fp", radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that join whatever lies within the radius."""
    if radius > 3:
        raise ValueError("five blocks prove distances up to 3 only")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        nodes.select(F.col(fp).alias("fp"))
        .select("fp", F.posexplode(_keys(F.col("fp"))).alias("pair", "key"))
        .repartition(parts, "pair", "key").sortWithinPartitions("pair", "key", "fp")
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, ["pair", "key", "fp"]):
            if found := shard_links(shard[2].view(np.uint64).tolist(), radius):
                both = np.array(found, np.uint64).view(np.int64)
                yield pa.record_batch({"a": both[:, 0], "b": both[:, 1]})

    return dealt.mapInArrow(joined, "a long, b long").distinct()


def _keys(fp: Column) -> Column:
    """A fingerprint's bits in each pair of blocks."""
    return F.array(*[fp.bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)) for m in MASKS])


def _components_of(own: DataFrame, order: Column) -> DataFrame:
    """(fp, first): for each fingerprint of ``own`` the least ``order`` of its component."""
    nodes = keep(own.groupBy("fp").agg(F.min(order).alias("first")), "simhash")
    edges = keep(links(nodes), "simhash")
    named = nodes.join(components(edges).withColumnRenamed("node", "fp"), "fp", "left").withColumn("top", F.coalesce("top", "fp"))
    names = named.groupBy("top").agg(F.min("first").alias("first"))
    return keep(named.drop("first").join(names, "top").select("fp", "first"), "simhash")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id that links lead to) of every row.

    A null doc_id takes part: it is in a component, but never its name unless all are null.
    """
    own = keep(docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text)).alias("fp")), "simhash")
    of = _components_of(own, F.col("doc_id")).withColumnRenamed("first", "component_id")
    return own.join(of, "fp").select("doc_id", "fp", "component_id")


def first_of_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of each group with the smallest doc_id (null ids last, then by a hash of the text); one of
    them if rows repeat.  Texts without words are one group.

    One pass makes the fingerprints; texts move once, to meet the ids that stay.
    """
    own = keep(docs.select(
        F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("body")).alias("row"),
        fingerprints(F.col(text)).alias("fp")), "simhash")
    firsts = _components_of(own, F.col("row")).select(F.col("first.doc_id").alias("__id"), F.col("first.body").alias("__key")).distinct()
    rows = docs.withColumn("__body", F.xxhash64(text))
    return (
        rows.join(firsts, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__body") == F.col("__key")), "left_semi")
        .dropDuplicates([doc_id, "__body"]).drop("__body")
    )


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

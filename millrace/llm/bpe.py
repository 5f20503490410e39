"""Byte-level BPE by two tiers: whole pre-tokens through a minimal perfect hash of the
vocabulary, all others by merging linked bytes from a heap.

A null text counts as empty and has no ids.  Texts are taken whole.  Lone surrogates
cannot occur: Spark strings are UTF-8.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from millrace.llm.memory import returning

MASK = (1 << 64) - 1
STEP = 0x9E3779B97F4A7C15
#: Pre-tokens of a generation; a task remembers two generations at most.
REMEMBERED = 100_000
#: Bytes of text of which a task holds ids and pieces before they become Arrow's and are handed on.
SLICE = 4 << 20
#: Bits of a heap's entry that are the place, the rest are the rank: so few for most pieces that an entry
#: is one digit of Python's numbers.
PLACE = 14
LONG_PLACE = 40


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class PerfectHash:
    """Minimal perfect hash by hash-and-displace: a key's hash names a bucket, the bucket's
    displacement sends each of its keys to a slot of its own; there are as many slots as
    keys.  Buckets of one key come last and name their slot outright (as -1 - slot).  The
    slot holds the key, so strangers are told apart."""

    def __init__(self, ranks: dict[bytes, int]):
        size = len(ranks)
        self.size, self.buckets = size, max(1, size // 3)
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * size
        self.ranks = [0] * size
        groups: list[list[tuple[int, bytes]]] = [[] for _ in range(self.buckets)]
        for key in ranks:
            h = xxhash.xxh3_64_intdigest(key)
            groups[h % self.buckets].append((h, key))
        several = [b for b in range(self.buckets) if len(groups[b]) > 1]
        for b in sorted(several, key=lambda b: -len(groups[b])):
            d = 0
            while True:
                slots = [self._slot(h, d) for h, _ in groups[b]]
                if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                    for s, (_, key) in zip(slots, groups[b]):
                        self.keys[s], self.ranks[s] = key, ranks[key]
                    break
                d += 1
            self.shift[b] = d
        free = iter([s for s in range(size) if self.keys[s] is None])
        for b in range(self.buckets):
            if len(groups[b]) == 1:
                s, key = next(free), groups[b][0][1]
                self.keys[s], self.ranks[s], self.shift[b] = key, ranks[key], -1 - s

    def _slot(self, h: int, d: int) -> int:
        if d < 0:
            return -1 - d
        return ((((h ^ (d * STEP)) * STEP) & MASK) >> 20) % self.size

    def get(self, key: bytes) -> int | None:
        if not self.size:
            return None
        h = xxhash.xxh3_64_intdigest(key)
        s = self._slot(h, self.shift[h % self.buckets])
        return self.ranks[s] if self.keys[s] == key else None


def byte_pairs(rank: dict[bytes, int]) -> list[int]:
    """Ranks of all pairs of bytes (-1: none) by the number that the two make."""
    out = [-1] * (1 << 16)
    for token, r in rank.items():
        if len(token) == 2:
            out[token[0] << 8 | token[1]] = r
    return out


def merge(piece: bytes, rank: dict[bytes, int], pairs: list[int] | None = None) -> list[int]:
    """Ids of a piece: again and again the pair of neighbours of least rank (the leftmost
    of equals) becomes one part.  Parts are a linked list, pairs wait in a heap; ``pair`` has the
    rank of the pair that begins at a place now, so one that has changed since is passed over.
    ``pairs`` are the ``byte_pairs`` of the ranks."""
    pairs = pairs or byte_pairs(rank)
    n, get = len(piece), rank.get
    shift = PLACE if n < 1 << PLACE else LONG_PLACE
    place = (1 << shift) - 1
    pair = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]
    heap = [r << shift | i for i, r in enumerate(pair) if r >= 0]
    heapify(heap)
    pair.append(-1)
    after, before, merged = list(range(1, n + 1)), list(range(-1, n)), [-1] * n
    while heap:
        top = heappop(heap)
        i, r = top & place, top >> shift
        if pair[i] != r:
            continue
        merged[i] = r
        j = after[i]
        end = after[i] = after[j]
        pair[j] = -1
        if end < n:
            before[end] = i
            r = pair[i] = get(piece[i:after[end]], -1)
            if r >= 0:
                heappush(heap, r << shift | i)
        else:
            pair[i] = -1
        k = before[i]
        if k >= 0:
            r = pair[k] = get(piece[k:end], -1)
            if r >= 0:
                heappush(heap, r << shift | k)
    ids, i = [], 0
    while i < n:
        r = merged[i]
        ids.append(r if r >= 0 else rank[piece[i:i + 1]])
        i = after[i]
    return ids


class Encoder:
    """Pre-tokens and their ids as little-endian unsigned 32-bit integers, remembered in two
    generations: when the young one is full it becomes the old one, and what nobody asked for
    since is forgotten."""

    def __init__(self, ranks: dict[bytes, int], whole: PerfectHash, pattern: str, remembered: int = REMEMBERED):
        self.rank, self.whole, self.remembered = ranks, whole, remembered
        self.pairs = byte_pairs(ranks)
        self.split = regex.compile(pattern).findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, token: str) -> bytes:
        out = self.young.get(token)
        if out is not None:
            return out
        out = self.old.get(token)
        if out is None:
            piece = token.encode()
            one = self.whole.get(piece)
            ids = (one,) if one is not None else merge(piece, self.rank, self.pairs)
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(self.young) >= self.remembered:
            self.young, self.old = {}, self.young
        self.young[token] = out
        return out

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        tokens = self.split(text)
        found = list(map(self.young.get, tokens))
        if None in found:
            found = [self._ids(t) if f is None else f for t, f in zip(tokens, found)]
        return b"".join(found)


def pieces_of(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id."""
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, i in ranks.items():
        out[i] = piece
    return out


def decoded(ids: bytes | None, pieces: np.ndarray) -> bytes:
    return b"".join(pieces[np.frombuffer(ids or b"", "<u4")].tolist())


def _shared(spark: SparkSession, ranks_path: str):
    """Ranks and perfect hash.  The driver reads the vocabulary (its size is fixed by the file, some
    tens of thousands of entries) and hands it to the workers."""
    ranks = read_ranks(ranks_path)
    return spark.sparkContext.broadcast((ranks, PerfectHash(ranks)))


def sliced(batch: pa.Array) -> Iterator[list]:
    """The values of a batch, some ``SLICE`` bytes at a time."""
    size = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // SLICE)) + 1).tolist(), len(size)]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a).to_pylist()


def encoder(spark: SparkSession, ranks_path: str, pattern: str):
    """Column function: string -> ids, as the bytes of little-endian unsigned 32-bit integers."""
    shared = _shared(spark, ranks_path)

    @returning
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = Encoder(*shared.value, pattern)
        for batch in texts:
            for part in sliced(batch):
                yield pa.array([of.encode(t) for t in part], pa.binary())

    return F.arrow_udf(encode, "binary")


def decoder(spark: SparkSession, ranks_path: str):
    """Column function: ids (bytes as from ``encoder``) -> the bytes of the text."""
    shared = spark.sparkContext.broadcast(pieces_of(read_ranks(ranks_path)))

    @returning
    def decode(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = np.array(shared.value, object)
        for batch in ids:
            for part in sliced(batch):
                yield pa.array([decoded(x, pieces) for x in part], pa.binary())

    return F.arrow_udf(decode, "binary")


def round_trip(spark: SparkSession, ranks_path: str, pattern: str):
    """Column function: string -> struct of its ids and of the bytes that they decode to, in one
    worker, which then holds one vocabulary and a slice of a batch beside what it hands on."""
    shared = _shared(spark, ranks_path)

    @returning
    def both(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = Encoder(*shared.value, pattern)
        pieces = np.array(pieces_of(of.rank), object)
        for batch in texts:
            for part in sliced(batch):
                ids = [of.encode(t) for t in part]
                yield pa.StructArray.from_arrays(
                    [pa.array(ids, pa.binary()), pa.array([decoded(x, pieces) for x in ids], pa.binary())], names=["ids", "decoded"])

    return F.arrow_udf(both, "ids binary, decoded binary")


def count(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")

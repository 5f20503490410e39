"""Removal of repeated substrings by enhanced suffix arrays, dealt out by anchors.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts in a document with a
smaller doc_id.  No document is compared with another as a whole:

1. Every window of ``LENGTH`` bytes has an anchor, the k-mer in it whose hash is least.  Equal
   windows have equal anchors.  Neighbouring windows with one anchor make a segment.
2. Blocks of documents send the sorted hashes of their anchors to buckets by value.  Hashes
   that two documents have come back as suspects; most text has none and goes no further.
3. Blocks send the segments of suspect anchors to buckets, equal ones once with their places.
   A bucket builds the suffix array of its segments with the longest common prefixes, and a
   stack scan finds the intervals of the common-prefix tree.  An interval of ``LENGTH`` or more
   whose suffixes have different left neighbours is a maximal repeat; all its suffixes are its
   occurrences, and those outside its first document are removed.
4. Blocks gather what is removed of their documents.

What moves is compressed: hashes in byte planes, segments sorted by anchor.  A repeat longer
than a segment is found piece by piece and joined again in its document.

A null text counts as empty.  A null doc_id is larger than any other.  Documents with equal ids
do not remove from each other.  An empty table gives an empty result.  Matches never cross
documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.scratch import keep

LENGTH = 50
KMER = 24
#: Bytes of text in a block, that are scanned at a time, and per bucket.
BLOCK = 3 << 20
CHUNK = 1 << 19
BUCKET = 4 << 20
#: Segments in a suffix array and spans that are worked on at a time, about.
SEGMENTS = 1 << 12
SPANS = 1 << 17
KEY_BITS = 48
LAST = np.iinfo(np.int64).max
_U = np.uint64


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 3)


def _unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as planes of bytes, of which the high ones hardly cost anything."""
    return _pack(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BITS // 8].T)


def _unpack_keys(data: bytes) -> np.ndarray:
    planes = _unpack(data, np.uint8).reshape(KEY_BITS // 8, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :KEY_BITS // 8] = planes.T
    return out.view("<u8").ravel()


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, first and last window of each segment of the documents data[starts[i]:ends[i]]."""
    n = len(data)
    kmer = min(KMER, length)
    if n < length:
        return np.empty(0, _U), np.empty(0, np.int64), np.empty(0, np.int64)
    if kmer == 24:
        two = data[:-1].astype(np.uint16) | (data[1:].astype(np.uint16) << np.uint16(8))
        four = two[:-2].astype(np.uint32) | (two[2:].astype(np.uint32) << np.uint32(16))
        eight = four[:-4].astype(_U) | (four[4:].astype(_U) << _U(32))
        h = eight[:-16] * _U(0x9E3779B97F4A7C15)
        h += eight[8:-8] * _U(0xC2B2AE3D27D4EB4F)
        h += eight[16:] * _U(0x165667B19E3779F9)
    else:  # short windows, as in tests
        h = np.zeros(n - kmer + 1, _U)
        for i in range(kmer):
            h = h * _U(0x100000001B3) + data[i:n - kmer + 1 + i] + _U(1)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    least = (h & ~_U((1 << 24) - 1)) | np.arange(len(h), dtype=_U)  # equal hashes: the first
    width, have = length - kmer + 1, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[:have - width], least[width - have:])
    at = (least & _U((1 << 24) - 1)).astype(np.int64)
    mark = np.zeros(n + 1, np.int8)
    long = ends - starts >= length
    np.add.at(mark, starts[long], 1)
    np.add.at(mark, ends[long] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(mark[:len(at)], dtype=np.int8))
    if not len(window):
        return np.empty(0, _U), window, window
    at = at[window]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)])
    return h[at[new]] >> _U(64 - KEY_BITS), window[new], window[np.r_[new[1:], len(window)] - 1]


class Block:
    """Documents in one piece: their ids, where they start and end, their bytes."""

    def __init__(self, ids: list, lengths: list, data: bytes):
        self.ids = np.array([LAST if i is None else i for i in ids], np.int64)
        self.ends = np.cumsum(np.array(lengths, np.int64))
        self.starts = self.ends - np.array(lengths, np.int64)
        self.raw = zstandard.decompress(data) if data else b""
        self.data = np.frombuffer(self.raw, np.uint8)

    def segments(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Key, document, start and end of all segments."""
        parts, first = [], 0
        while first < len(self.ids):
            last = max(first + 1, int(np.searchsorted(self.ends, self.starts[first] + CHUNK, "right")))
            step, begin, stop = (CHUNK << 2), int(self.starts[first]), int(self.ends[last - 1])
            # a document longer than a chunk goes piece by piece, pieces sharing length - 1 bytes
            for lo in range(begin, max(stop - length + 1, begin + 1), step):
                hi = min(lo + step + length - 1, stop)
                s = np.clip(self.starts[first:last], lo, hi) - lo
                e = np.clip(self.ends[first:last], lo, hi) - lo
                key, a, b = anchors(self.data[lo:hi], s, e, length)
                parts.append((key, a + lo, b + lo + length))
            first = last
        if not parts:
            return (np.empty(0, _U), *[np.empty(0, np.int64)] * 3)
        key, start, end = (np.concatenate(x) for x in zip(*parts))
        return key, np.searchsorted(self.ends, start, "right"), start, end


def _blocks(docs: DataFrame) -> DataFrame:
    """Stored: block, doc_ids, lengths, data of about ``BLOCK`` bytes of documents each."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"doc_ids": ids, "lengths": [len(t) for t in texts], "data": zstandard.compress(b"".join(texts), 3)}],
                pa.schema([("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("data", pa.binary())]))

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                texts.append(t or b"")
                size += len(texts[-1])
                if size >= BLOCK:
                    yield row()
                    ids, texts, size = [], [], 0
        if ids:
            yield row()

    rows = docs.mapInArrow(packed, "doc_ids array<long>, lengths array<long>, data binary")
    return keep(rows.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _of(row: dict) -> Block:
    return Block(row["doc_ids"], row["lengths"], row["data"])


def _bucketed(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> _U(KEY_BITS - 24)) * _U(buckets) >> _U(24)).astype(np.int64)


def _suspects(blocks: DataFrame, buckets: int, length: int) -> DataFrame:
    """block, keys: the anchors of a block that two documents, here or elsewhere, have."""
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                key, doc, _, _ = _of(row).segments(length)
                order = np.lexsort((doc, key))
                key, doc = key[order], doc[order]
                new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
                last = np.r_[new[1:], len(key)] - 1
                several, key = doc[new] != doc[last] if len(key) else np.empty(0, bool), key[new]
                to = _bucketed(key, buckets)
                cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else []
                out = [{"bucket": int(to[a]), "block": row["block"], "keys": _pack_keys(key[a:b]), "several": _pack(np.packbits(several[a:b]))}
                       for a, b in zip(cuts, [*cuts[1:], len(to)])]
                if out:
                    yield pa.RecordBatch.from_pylist(out)

    def resolved(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        keys = [_unpack_keys(r["keys"]) for r in rows]
        several = np.concatenate([np.unpackbits(_unpack(r["several"], np.uint8))[:len(k)] for r, k in zip(rows, keys)])
        sizes, key = [len(k) for k in keys], np.concatenate(keys)
        of = np.repeat(np.arange(len(rows)), sizes)
        order = np.argsort(key, kind="stable")
        key, of, several = key[order], of[order], several[order]
        new = np.r_[True, key[1:] != key[:-1]]
        run = np.cumsum(new) - 1
        size = np.bincount(run)
        hit = (size[run] > 1) | (several > 0)
        key, of = key[hit], of[hit]
        back = np.argsort(of, kind="stable")
        key, of = key[back], of[back]
        found, start = np.unique(of, return_index=True)
        return pa.table({"block": pa.array([rows[i]["block"] for i in found], pa.int64()),
                         "keys": pa.array([_pack_keys(x) for x in np.split(key, start[1:])] if len(found) else [], pa.binary())})

    return (
        blocks.mapInArrow(sent, "bucket long, block long, keys binary, several binary")
        .groupBy("bucket").applyInArrow(resolved, "block long, keys binary")
    )


def _sent_segments(blocks: DataFrame, suspects: DataFrame, buckets: int, length: int) -> DataFrame:
    """bucket, block and the segments of suspect anchors, equal ones of a block once."""
    kind = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("sizes", pa.binary()),
                      ("text", pa.binary()), ("times", pa.binary()), ("docs", pa.binary()), ("ids", pa.binary()), ("starts", pa.binary())])

    def sent(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            row = left.to_pylist()[0]
            block = _of(row)
            key, doc, start, end = block.segments(length)
            known = np.sort(np.concatenate([_unpack_keys(x.as_py()) for x in right.column("keys")]))
            i = np.minimum(np.searchsorted(known, key), len(known) - 1)
            hit = np.flatnonzero(known[i] == key)
            hit = hit[np.argsort(key[hit], kind="stable")]
            key, doc, start, end = key[hit], doc[hit], start[hit], end[hit]
            to = _bucketed(key, buckets)
            cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
            for a, b in zip(cuts, [*cuts[1:], len(to)]):
                raw, places = block.raw, {}  # of one bucket at a time
                for j, (s, e) in enumerate(zip(start[a:b].tolist(), end[a:b].tolist()), int(a)):
                    places.setdefault(raw[s:e], []).append(j)
                order = np.array([j for js in places.values() for j in js])
                first = [js[0] for js in places.values()]
                out.append({
                    "bucket": int(to[a]), "block": row["block"], "keys": _pack(key[first]), "sizes": _pack(np.array([len(x) for x in places], "<u2")),
                    "text": zstandard.compress(b"".join(places), 3), "times": _pack(np.array([len(x) for x in places.values()], "<u4")),
                    "docs": _pack(doc[order].astype("<u4")), "ids": _pack(block.ids[doc[order]]),
                    "starts": _pack((start - block.starts[doc])[order].astype("<u4"))})
        return pa.Table.from_pylist(out, kind)

    return blocks.groupBy("block").cogroup(suspects.groupBy("block")).applyInArrow(
        sent, "bucket long, block long, keys binary, sizes binary, text binary, times binary, docs binary, ids binary, starts binary")


def repeated_windows(text: bytes, ends: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of strings that follow each other in ``text``: string and offset of the windows of
    ``length`` bytes whose hash another window has too.  Only they can start a repeat."""
    data = np.frombuffer(text, np.uint8)
    hashes, places, first = [], [], 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + CHUNK, "right")))
        begin = int(ends[first] - sizes[first])
        part = data[begin:int(ends[last - 1])].astype(_U)
        h = np.zeros(len(part) - length + 1, _U)
        have = 1  # part[i] stands for the bytes from i to i + have
        while have * 2 <= min(length, 8):
            part = part[:-have] | (part[have:] << _U(8 * have))
            have *= 2
        for at in (*range(0, length - have, have), length - have):
            h *= _U(0x9E3779B97F4A7C15)
            h ^= h >> _U(29)
            h += part[at:at + len(h)]
        h *= _U(0xD6E8FEB86659FD93)
        h ^= h >> _U(32)
        count = sizes[first:last] - length + 1
        begins = ends[first:last] - sizes[first:last] - begin
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        hashes.append(h[at + np.repeat(begins, count)])
        places.append((np.repeat(np.arange(first, last), count), at))
        first = last
    h = np.concatenate(hashes)
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    hit = np.zeros(len(h), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    of, offset = (np.concatenate(x) for x in zip(*places))
    return of[hit], offset[hit]


def suffix_array(text: bytes, ends: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of strings that follow each other in ``text``: the suffixes that may start a repeat of
    ``length`` bytes or more, in sorted order (string, offset), the common prefix of each with
    the one before, and the byte to its left (256 at a string's start)."""
    of, offset = repeated_windows(text, ends, sizes, length)
    if not len(of):
        return of, offset, offset, offset
    start = (ends - sizes)[of] + offset
    size = sizes[of] - offset
    longest = int(size.max())
    words = -(-longest // 8)
    data = np.frombuffer(text + bytes(words * 8), np.uint8)
    columns = []
    for w in range(words):
        chunk = data[(start + w * 8)[:, None] + np.arange(8)]
        left = size - w * 8
        chunk = np.where(np.arange(8) < left[:, None], chunk, 0).astype(np.uint8) if w * 8 + 8 > length else chunk
        columns.append(np.ascontiguousarray(chunk).view(">u8").ravel().astype(_U))
    order = np.lexsort(columns[::-1])
    common = np.zeros(len(order), np.int64)
    alive = np.ones(max(0, len(order) - 1), bool)
    for w in range(words):
        here = columns[w][order]
        differ = here[1:] ^ here[:-1]
        same = np.where(differ == 0, 8, 0)
        rest = np.flatnonzero(alive & (differ != 0))
        # equal high bytes of the word: leading zero bits of the difference over 8
        same[rest] = (63 - np.floor(np.log2(differ[rest].astype(np.longdouble))).astype(np.int64)) // 8
        common[1:] += np.where(alive, same, 0)
        alive &= differ == 0
    size = size[order]
    common[1:] = np.minimum(common[1:], np.minimum(size[1:], size[:-1]))
    start, offset = start[order], offset[order]
    return of[order], offset, common, np.where(offset > 0, data[start - 1].astype(np.int64), 256)


def maximal_repeats(common: np.ndarray, left: np.ndarray, first: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, prefix, least) of each interval of the common-prefix tree with a prefix of
    ``length`` or more and different left neighbours.  ``first`` has a number per suffix;
    ``least`` is its minimum over the interval.

    One pass with a stack of open intervals; a closed interval hands its left neighbour (-1 if
    there are several) and its minimum to the one around it.
    """
    edges = np.flatnonzero(common < length)
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(common)]):
        if b - a < 2:
            continue
        stack: list[list[int]] = []  # prefix, start, left, least
        lcp, near, number = common[a + 1:b].tolist(), left[a:b].tolist(), first[a:b].tolist()
        lcp.append(0)
        for i in range(len(near)):
            start, mark, least, up = a + i, near[i], number[i], lcp[i]
            while stack and stack[-1][0] > up:
                top = stack.pop()
                # the suffix just read, or what closed before, lies in the top interval
                mark = mark if mark == top[2] and mark != 256 else -1
                least, start = min(least, top[3]), top[1]
                if mark == -1:
                    yield start, a + i + 1, top[0], least
            if not up:
                continue
            if stack and stack[-1][0] == up:
                top = stack[-1]
                top[2] = mark if mark == top[2] and mark != 256 else -1
                top[3] = min(least, top[3])
            else:
                stack.append([up, start, mark, least])


def _joined(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans' union in each document."""
    if not len(doc):
        return doc, begin, end
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    other = np.r_[True, doc[1:] != doc[:-1]]
    base = (np.cumsum(other) - 1) << 32
    reach = np.maximum.accumulate(end + base) - base
    new = np.flatnonzero(other | np.r_[True, begin[1:] > reach[:-1]])
    return doc[new], begin[new], reach[np.r_[new[1:], len(doc)] - 1]


def _merged(spans: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """segment, start, end, least: what overlaps with an equal segment and ``least`` in one."""
    of, least, start, end = (np.concatenate(x) for x in zip(*spans))
    if not len(of):
        return of, start, end, least
    order = np.lexsort((least, of))
    of, least, start, end = of[order], least[order], start[order], end[order]
    group = np.cumsum(np.r_[False, (of[1:] != of[:-1]) | (least[1:] != least[:-1])])
    head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    group, start, end = _joined(group, start, end)
    return of[head[group]], start, end, least[head[group]]


def _spans(names: list[bytes], keys: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """segment, start, end, least of what repeats in the segments ``names``: it goes from all
    documents larger than ``least``."""
    sizes = np.array([len(s) for s in names], np.int64)
    # a segment that stands in several documents repeats as a whole
    spans = [(np.arange(len(sizes)), first, np.zeros(len(sizes), np.int64), sizes)]
    # segments that share their anchor with others go into a suffix array, some anchors at a time
    order = np.argsort(keys, kind="stable")
    new = np.flatnonzero(np.r_[True, keys[order[1:]] != keys[order[:-1]]])
    many = np.diff(np.r_[new, len(order)])
    new, many = new[many > 1], many[many > 1]
    turn = np.cumsum(many) // SEGMENTS
    for part in np.split(np.arange(len(new)), np.flatnonzero(np.diff(turn)) + 1) if len(new) else []:
        inner = np.concatenate([order[new[i]:new[i] + many[i]] for i in part])
        own = sizes[inner]
        of, offset, common, left = suffix_array(b"".join(names[i] for i in inner.tolist()), np.cumsum(own), own, length)
        of = inner[of]
        batch: list[tuple[int, int, int, int]] = []
        room = SPANS
        for found in chain(maximal_repeats(common, left, first[of], length), [None]):
            if found is not None:
                batch.append(found)
                room -= found[1] - found[0]
            if batch and (found is None or room <= 0):
                a, b, prefix, least = (np.array(x, np.int64) for x in zip(*batch))
                wide = np.repeat(np.arange(len(a)), b - a)
                at = np.arange(len(wide)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[wide]
                seg, start, end, low = _merged([(of[at], least[wide], offset[at], offset[at] + prefix[wide])])
                spans.append((seg, low, start, end))
                batch, room = [], SPANS
    return _merged(spans)


def _resolved(group: pa.Table, length: int) -> pa.Table:
    """block, docs, starts, ends: what goes, from one bucket's segments.

    A block's places are unpacked for that block alone, since a string of few letters may stand
    in millions of them."""
    def of_row(k: int, name: str) -> bytes:
        return group.column(name)[k].as_py()

    number: dict[bytes, int] = {}
    keys, rows, ids = [], [], []
    for k in range(group.num_rows):
        text, at, own = zstandard.decompress(of_row(k, "text")), 0, []
        for size, key in zip(_unpack(of_row(k, "sizes"), "<u2").tolist(), _unpack(of_row(k, "keys"), "<u8").tolist()):
            seg = text[at:at + size]
            at += size
            if (i := number.get(seg)) is None:
                i = number[seg] = len(number)
                keys.append(key)
            own.append(i)
        times = _unpack(of_row(k, "times"), "<u4").astype(np.int64)
        rows.append((np.array(own, np.int64), times))
        ids.append(np.minimum.reduceat(_unpack(of_row(k, "ids"), "<i8"), np.cumsum(times) - times))
    first = np.full(len(number), LAST, np.int64)
    for (own, _), least in zip(rows, ids):
        first[own] = np.minimum(first[own], least)
    of, offset, stop, least = _spans(list(number), np.array(keys, _U), first, length)
    del number, keys, ids
    bounds = np.searchsorted(of, np.arange(len(first) + 1))
    out = []
    for k, (own, times) in enumerate(rows):
        seg = np.repeat(own, times)
        doc, start, name = _unpack(of_row(k, "docs"), "<u4"), _unpack(of_row(k, "starts"), "<u4"), _unpack(of_row(k, "ids"), "<i8")
        parts = []
        turn = np.cumsum(bounds[seg + 1] - bounds[seg]) // SPANS
        for lo, hi in pairwise([0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), len(seg)]):
            part = slice(lo, hi)
            low, many = bounds[seg[part]], bounds[seg[part] + 1] - bounds[seg[part]]
            place = np.repeat(np.arange(len(many)), many)
            at = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many) + low[place]
            gone = name[part][place] > least[at]
            place, at = place[gone], at[gone]
            begin = start[part][place].astype(np.int64)
            parts.append(_joined(doc[part][place].astype(np.int64), begin + offset[at], begin + stop[at]))
        doc, begin, end = _joined(*(np.concatenate(x) for x in zip(*parts)))
        if len(doc):
            out.append({"block": of_row(k, "block"), "docs": _pack(doc.astype("<u4")), "starts": _pack(begin.astype("<u4")), "ends": _pack(end.astype("<u4"))})
    return pa.Table.from_pylist(out, pa.schema([("block", pa.int64()), ("docs", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary())]))


def _cut(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a block with their removed spans and kept bytes."""
    kind = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept", pa.binary())])
    if not left.num_rows:
        return pa.Table.from_pylist([], kind)
    row = left.to_pylist()[0]
    block = _of(row)
    gather = lambda name: np.concatenate([_unpack(x.as_py(), "<u4") for x in right.column(name)]).astype(np.int64) if right.num_rows else np.empty(0, np.int64)
    doc, begin, end = gather("docs"), gather("starts"), gather("ends")
    change = np.zeros(len(block.data) + 1, np.int32)
    np.add.at(change, block.starts[doc] + begin, 1)
    np.add.at(change, block.starts[doc] + end, -1)
    gone = np.cumsum(change[:-1]) > 0
    hit = np.zeros(len(block.ids), bool)
    hit[doc] = True
    out = []
    for i, (name, a, b) in enumerate(zip(row["doc_ids"], block.starts.tolist(), block.ends.tolist())):
        starts, ends, kept = [], [], block.raw[a:b]
        if hit[i]:
            mask = gone[a:b]
            turn = np.flatnonzero(np.diff(np.r_[0, mask.view(np.int8), 0]))
            starts, ends, kept = turn[::2].tolist(), turn[1::2].tolist(), block.data[a:b][~mask].tobytes()
        out.append({"doc_id": name, "n_bytes": b - a, "starts": starts, "ends": ends, "kept": kept})
    return pa.Table.from_pylist(out, kind)


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, starts and ends of the removed spans in the text's UTF-8 bytes, and the
    bytes kept (a cut may split a character)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    blocks = _blocks(docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text")))
    total = blocks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = total // BUCKET + 1
    suspects = keep(_suspects(blocks, buckets, length), "suspects")
    gone = keep(
        _sent_segments(blocks, suspects, buckets, length).groupBy("bucket")
        .applyInArrow(lambda group: _resolved(group, length), "block long, docs binary, starts binary, ends binary"), "gone")
    return blocks.groupBy("block").cogroup(gone.groupBy("block")).applyInArrow(
        _cut, "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary")

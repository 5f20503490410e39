"""Alignment of two tokenizers over the same text by an associative monoid of fragments.

A text is read as a space and the text.  The byte offsets where a token of A and a token of B
both end cut the tokens into groups.  A byte range of a text gives a fragment: the tokens up to
the first common end (open to the left), the closed groups, and the tokens behind the last
common end (open to the right).  Two neighbouring fragments compose: what the left one has open
and what the right one has open is scanned again.  Composition is associative, so the
fragments of a very long text are made in different tasks and composed as a tree,
``FAN`` neighbours a round.  Texts of up to ``CHUNK`` characters are one fragment.

A and B are cut apart each where its own tokens must end whatever surrounds them: A where a
pre-token ends, B between characters that no piece has side by side.  So the tokens are those of the
whole text.  A text without such a place is one fragment, however long.

A link is a pair of token occurrences whose byte ranges overlap.  Links are counted by id pair
over the corpus.  A pair with at least one ``HOT``-th of all links is looked up in a table of
bounded size (at most ``HOT`` rows) in every task; all others meet their documents in a join, in which
by that bound no key is hot.

Texts that are null, empty, or of which a tokenizer does not give back the bytes have no tokens:
zeros and an empty string.  Rows with a null or repeated id are aligned like any other, each by itself.
An empty table gives an empty result; columns beside id and text are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.vocabularies import ByteBPE, PieceBPE, contents, join
from millrace.scratch import keep

CHUNK = 1 << 15
FAN = 16
#: Pairs in the table that every task gets: 17 bytes each.
HOT = 1 << 18
#: Bytes of text that are aligned before their rows are handed on.
SLICE = 1 << 20
#: Links counted together in a task.
COUNTED = 1 << 22
#: Ends of pre-tokens that need no look further: a word before white space, a letter or digit
#: before ASCII punctuation, a letter before a digit or the reverse.
_END_OF_A = regex.compile(r"(?<=[!-~])(?=[ \n])|(?<=[A-Za-z0-9\u4e00-\u9fa5])(?=[!-/:-@\[-`{-~\u3001\u3002\uff0c])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


@dataclass
class Span:
    """Neighbouring tokens: ids and byte offsets of their ends."""

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray

    def __add__(self, other: Span) -> Span:
        return Span(*(np.concatenate(x) for x in zip(self.parts(), other.parts())))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.b, self.ends_a, self.ends_b

    def cut(self, low: int, high: int) -> Span:
        """Tokens that end behind ``low`` and not behind ``high``."""
        i, j = np.searchsorted(self.ends_a, (low, high), "right")
        k, m = np.searchsorted(self.ends_b, (low, high), "right")
        return Span(self.a[i:j], self.b[k:m], self.ends_a[i:j], self.ends_b[k:m])

    def common(self) -> np.ndarray:
        at = np.searchsorted(self.ends_a, self.ends_b)
        met = at < len(self.ends_a)
        met[met] = self.ends_a[at[met]] == self.ends_b[met]
        return self.ends_b[met]

    def packed(self) -> bytes:
        return np.concatenate([[len(self.a), len(self.b)], *self.parts()]).astype("<i8").tobytes()

    @staticmethod
    def unpacked(data: bytes) -> Span:
        x = np.frombuffer(data, "<i8")
        n, m = x[0], x[1]
        return Span(*np.split(x[2:], np.cumsum([n, m, n])))


NOTHING = Span(*[np.zeros(0, np.int64)] * 4)


@lru_cache(maxsize=1)
def _names(size: int) -> np.ndarray:
    """Ids below ``size`` in decimal digits, three times: with a comma, a bar, a semicolon behind."""
    return np.array([f"{i}{s}" for s in ",|;" for i in range(size)], object)


def rendered(span: Span, common: np.ndarray) -> str:
    """Groups of ids, ``a1,a2|b1;a3|b2,b3``, of a span that begins and ends at a common end."""
    of_a, of_b = np.searchsorted(common, span.ends_a), np.searchsorted(common, span.ends_b)
    in_a, in_b = np.bincount(of_a, minlength=len(common)), np.bincount(of_b, minlength=len(common))
    places_a = np.arange(len(of_a)) + (np.cumsum(in_b) - in_b)[of_a]
    places_b = np.arange(len(of_b)) + np.cumsum(in_a)[of_b]
    ids = np.empty(len(of_a) + len(of_b), np.int64)
    ids[places_a], ids[places_b] = span.a, span.b
    signs = np.zeros(len(ids), np.int64)
    signs[np.cumsum(in_a + in_b) - 1] = 2
    signs[np.cumsum(in_a + in_b) - in_b - 1] = 1
    size = 1 << max(16, int(ids.max(initial=0)).bit_length())
    return "".join(_names(size)[signs * size + ids].tolist())[:-1]


def links(span: Span, size_b: int) -> np.ndarray:
    """Pairs of overlapping tokens as id of A times ``size_b`` plus id of B.  Between two
    neighbouring ends, of A or of B, lies exactly one such pair."""
    ends = np.sort(np.concatenate([span.ends_a, span.ends_b]), kind="stable")
    ends = ends[np.diff(ends, append=-1) != 0]
    return span.a[np.searchsorted(span.ends_a, ends)] * size_b + span.b[np.searchsorted(span.ends_b, ends)]


@dataclass
class Fragment:
    """``head`` is open to the left; with ``closed`` it ends at a common end, and ``tail`` lies
    behind the last one.  ``groups`` and ``pairs`` are those of the closed groups."""

    head: Span = field(default_factory=lambda: NOTHING)
    tail: Span = field(default_factory=lambda: NOTHING)
    closed: bool = False
    groups: list[str] = field(default_factory=list)
    n_groups: int = 0
    n_a: int = 0
    n_b: int = 0
    pairs: list[np.ndarray] = field(default_factory=list)
    valid: bool = True

    def close(self, span: Span, common: np.ndarray, size_b: int) -> None:
        """Add groups on the right."""
        if len(common):
            self.groups.append(rendered(span, common))
            self.pairs.append(links(span, size_b))
            self.n_groups += len(common)
            self.n_a += len(span.a)
            self.n_b += len(span.b)

    def follow(self, other: Fragment) -> None:
        """Add the closed groups of a fragment on the right."""
        self.groups += other.groups
        self.pairs += other.pairs
        self.n_groups += other.n_groups
        self.n_a += other.n_a
        self.n_b += other.n_b


def scanned(span: Span, size_b: int) -> Fragment:
    common = span.common()
    if not len(common):
        return Fragment(head=span)
    first, last = int(common[0]), int(common[-1])
    out = Fragment(head=span.cut(-1, first), tail=span.cut(last, 1 << 62), closed=True)
    out.close(span.cut(first, last), common[1:], size_b)
    return out


def composed(left: Fragment, right: Fragment, size_b: int) -> Fragment:
    if not (left.valid and right.valid):
        return Fragment(valid=False)
    middle = scanned((left.tail if left.closed else left.head) + right.head, size_b)
    if not left.closed:
        out = Fragment(head=middle.head, closed=middle.closed, tail=middle.tail)
        out.follow(middle)
    else:
        out = Fragment(head=left.head, closed=True, tail=middle.head)
        out.follow(left)
        if middle.closed:
            out.close(middle.head, middle.head.ends_a[-1:], size_b)
            out.follow(middle)
            out.tail = middle.tail
    if right.closed:
        out.follow(right)
        out.tail = right.tail
    return out


def whole(text: Fragment, size_b: int) -> Fragment:
    """A whole text's fragment: its head is a group, as it begins where the text begins."""
    if not (text.valid and text.closed) or len(text.tail.a) or len(text.tail.b):
        return Fragment(valid=False)
    out = Fragment(closed=True)
    out.close(text.head, text.head.ends_a[-1:], size_b)
    out.follow(text)
    return out


class Aligner:
    def __init__(self, ranks: bytes, pattern: str, model: bytes):
        self.a, self.b = ByteBPE(ranks, pattern), PieceBPE(model)
        self.lengths_a, self.lengths_b = self.a.lengths(), self.b.lengths()

    def fragment(self, part_a: str, part_b: str, at_a: int = 0, at_b: int = 0) -> Fragment:
        """Of the text that A and B have of a chunk, which begin at these byte offsets."""
        a, b = self.a.encode(part_a), self.b.encode(part_b)
        if join(self.a.pieces, a) != part_a.encode() or join(self.b.pieces, b) != part_b.encode():
            return Fragment(valid=False)
        return scanned(Span(a, b, at_a + np.cumsum(self.lengths_a[a]), at_b + np.cumsum(self.lengths_b[b])), self.b.size)

    def text(self, text: str | None) -> Fragment:
        if not text:
            return Fragment(valid=False)
        return whole(self.fragment(" " + text, " " + text), self.b.size)

    def chunks(self, text: str, size: int) -> list[tuple[str, str, int, int]]:
        """(part for A, part for B, byte offset of either) of consecutive chunks."""
        full = " " + text
        cuts_a, cuts_b = [0], [0]
        for nominal in range(size, len(full), size):
            found = _END_OF_A.search(full, max(nominal, cuts_a[-1])) if cuts_a[-1] < len(full) else None
            cuts_a.append(found.start() if found else len(full))
            p = max(nominal, cuts_b[-1])
            while p < len(full) and not self.b.apart(full[p - 1], full[p]):
                p += 1
            cuts_b.append(min(p, len(full)))
        out, at_a, at_b = [], 0, 0
        for a, end_a, b, end_b in zip(cuts_a, [*cuts_a[1:], len(full)], cuts_b, [*cuts_b[1:], len(full)]):
            part_a, part_b = full[a:end_a], full[b:end_b]
            out.append((part_a, part_b, at_a, at_b))
            at_a += len(part_a.encode())
            at_b += len(part_b.encode())
        return out


def counted(pairs: list[np.ndarray]) -> tuple[bytes, bytes]:
    """Distinct pairs and how often each occurs."""
    if not pairs:
        return b"", b""
    keys, n = np.unique(np.concatenate(pairs), return_counts=True)
    return keys.astype("<i8" if keys[-1] >= 1 << 31 else "<i4").tobytes() if len(keys) else b"", n.astype("<u4").tobytes()


def keys_of(keys: bytes, n: bytes) -> np.ndarray:
    return np.frombuffer(keys, "<i4" if len(keys) == len(n) else "<i8")


_DONE = "n_a long, n_b long, n_groups long, n_links long, {} string, __keys binary, __n binary"
_OPEN = ("__row long, __seq long, valid boolean, closed boolean, head binary, tail binary, groups string, n_groups long, n_a long, "
         "n_b long, keys binary, n binary")


def _finished(found: Fragment, digest: bool) -> tuple:
    """A row's values behind its id."""
    if not found.valid:
        return 0, 0, 0, 0, "", b"", b""
    text = ";".join(found.groups)
    return (found.n_a, found.n_b, found.n_groups, sum(map(len, found.pairs)),
            hashlib.sha256(text.encode()).hexdigest() if digest else text, *counted(found.pairs))


def _slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches with about ``SLICE`` bytes of text each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        of = np.cumsum(sizes) // SLICE
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(sizes)] if len(sizes) else [0, 0]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _arrow(spec: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spec)


def _of_row(row: dict) -> Fragment:
    pairs = [np.repeat(keys_of(row["keys"], row["n"]).astype(np.int64), np.frombuffer(row["n"], "<u4"))] if row["keys"] else []
    return Fragment(Span.unpacked(row["head"]), Span.unpacked(row["tail"]), row["closed"], [row["groups"]] if row["n_groups"] else [],
                    row["n_groups"], row["n_a"], row["n_b"], pairs, row["valid"])


def _as_row(row: int, seq: int, f: Fragment) -> tuple:
    return (row, seq, f.valid, f.closed, f.head.packed(), f.tail.packed(), ";".join(f.groups), f.n_groups, f.n_a, f.n_b, *counted(f.pairs))


def _long(texts: DataFrame, aligner, digest: bool, chunk: int, size_b: int, fan: int) -> DataFrame:
    """Rows of texts of more than one chunk, whose chunks are dealt out to all tasks."""
    stored = keep(texts.withColumn("__row", F.monotonically_increasing_id()), "align-long")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner()
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                parts = own.chunks(text.as_py(), chunk)
                yield pa.RecordBatch.from_pylist([
                    {"__row": row, "__seq": i, "a": a, "b": b, "at_a": at_a, "at_b": at_b} for i, (a, b, at_a, at_b) in enumerate(parts)])

    chunks = stored.select("__row", "__text").mapInArrow(cut, "__row long, __seq long, a string, b string, at_a long, at_b long")
    spec = T.StructType.fromDDL(_OPEN)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, out = aligner(), _arrow(spec)
        for batch in _slices(batches, "a"):
            yield _rows([_as_row(r["__row"], r["__seq"], own.fragment(r["a"], r["b"], r["at_a"], r["at_b"])) for r in batch.to_pylist()], out)

    def compose(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["__seq"])
        all_of = _of_row(rows[0])
        for r in rows[1:]:
            all_of = composed(all_of, _of_row(r), size_b)
        return pa.Table.from_batches([_rows([_as_row(rows[0]["__row"], rows[0]["__seq"] // fan, all_of)], _arrow(spec))])

    fragments = keep(chunks.repartition("__row", "__seq").mapInArrow(align, spec), "align-fragments")
    most = fragments.agg(F.max("__seq").alias("m")).first()["m"]
    while most:
        fragments = fragments.groupBy("__row", F.expr(f"__seq DIV {fan}").alias("__of")).applyInArrow(compose, spec)
        most //= fan
    name = "groups_sha256" if digest else "groups"
    done = T.StructType([T.StructField("__row", T.LongType()), *T.StructType.fromDDL(_DONE.format(name)).fields])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield _rows([(r["__row"], *_finished(whole(_of_row(r), size_b), digest))], _arrow(done))

    return stored.select("__row", "__id").join(fragments.mapInArrow(finish, done), "__row").drop("__row")


def align(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, model_path: str, doc_id: str = "doc_id", text: str = "text",
          digest: bool = False, chunk: int = CHUNK, fan: int = FAN, hot: int = HOT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, and ``groups`` (with ``digest``:
    ``groups_sha256``, its SHA-256, or '' where there are no tokens).

    n_best counts the links whose pair is one of the most frequent with their id of B;
    count_sum adds up the corpus-wide counts of the links' pairs."""
    files = spark.sparkContext.broadcast((contents(ranks_path), contents(model_path)))

    def aligner() -> Aligner:
        return Aligner(files.value[0], pattern, files.value[1])

    size_b = PieceBPE(files.value[1]).size
    name = "groups_sha256" if digest else "groups"
    own = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    id_field = T.StructField("__id", own.schema["__id"].dataType)
    spec = T.StructType([id_field, *T.StructType.fromDDL(_DONE.format(name)).fields])

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, out = aligner(), _arrow(spec)
        for batch in _slices(batches, "__text"):
            yield _rows([(i, *_finished(of.text(t), digest)) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], out)

    large = F.coalesce(F.length("__text"), F.lit(0)) > chunk
    aligned = own.where(~large).mapInArrow(short, spec).unionByName(_long(own.where(large), aligner, digest, chunk, size_b, fan))
    aligned = keep(aligned.withColumn("__row", F.monotonically_increasing_id()), "aligned")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([keys, *(k for k, _ in held)])
            distinct, of = np.unique(every, return_inverse=True)
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, of, np.concatenate([n, *(m for _, m in held)]))
            return distinct, total

        waiting = 0
        for batch in batches:
            for k, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append((keys_of(k, m).astype(np.int64), np.frombuffer(m, "<u4").astype(np.int64)))
                waiting += len(held[-1][0])
                if waiting >= COUNTED:
                    keys, n = merged()
                    held, waiting = [], 0
                    if len(keys) >= COUNTED:
                        yield pa.record_batch({"key": keys, "n": n})
                        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, n = merged()
        yield pa.record_batch({"key": keys, "n": n})

    partial = aligned.where("n_links > 0").select("__keys", "__n").mapInArrow(count, "key long, n long")
    counts = partial.groupBy("key").agg(F.sum("n").alias("n"))
    # an id of B has at most as many partners as A has ids
    best = F.max("n").over(Window.partitionBy(F.col("key") % size_b))
    counts = keep(counts.withColumn("best", F.col("n") == best), "align-counts")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    least = max(1, -(-total // hot))
    table = counts.where(F.col("n") >= least).toArrow()
    order = np.argsort(table.column("key").to_numpy())
    known = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy(zero_copy_only=False)[order] for c in ("key", "n", "best")))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, best = known.value
        for batch in batches:
            out = []
            for row, k, m in zip(*(c.to_pylist() for c in batch.columns)):
                keys, times = keys_of(k, m).astype(np.int64), np.frombuffer(m, "<u4").astype(np.int64)
                at = np.searchsorted(key, keys)
                met = at < len(key)
                met[met] = key[at[met]] == keys[met]
                hit = at[met]
                out.append((row, int(times[met][best[hit]].sum()), int((n[hit] * times[met]).sum()),
                            [{"key": x, "times": y} for x, y in zip(keys[~met].tolist(), times[~met].tolist())]))
            yield _rows(out, _arrow(scored_spec))

    scored_spec = T.StructType.fromDDL("__row long, n_best long, count_sum long, rare array<struct<key: long, times: long>>")
    scored = keep(aligned.where("n_links > 0").select("__row", "__keys", "__n").mapInArrow(score, scored_spec), "align-scores")
    rare = (
        scored.where(F.size("rare") > 0).select("__row", F.inline("rare"))
        .join(counts.where(F.col("n") < least), "key")
        .select("__row", F.expr("IF(best, times, 0)").alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    )
    sums = scored.select("__row", "n_best", "count_sum").unionByName(rare).groupBy("__row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.drop("__keys", "__n").join(sums, "__row", "left").select(
        F.col("__id").alias(doc_id), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), name)

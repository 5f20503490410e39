"""Benchmark decontamination by latent semantic retrieval.

1. Corpus and benchmark are cut into passages of ``WINDOW`` words (the corpus's overlap by
   half).  Terms are the benchmark's words; their document frequencies come from all passages of
   the corpus.  Other words count in a passage's length as terms of the largest weight.
2. A passage is kept if its terms, each at the most that it can add to the product with any
   benchmark passage, may make up ``SHARE`` of one.  So is every passage whose words do not rule out the
   check of step 5: of a benchmark passage no more distinct words are missing than words may be.
3. A randomised SVD of the kept passages and the benchmark's, both halves of equal weight:
   tasks multiply the sketch by their rows, the sums have the sketch's size whatever the input.
4. A kept passage is a candidate for the benchmark passages to which its cosine in the latent
   space is at least ``COSINE``, and for those of which it may hold ``SAME`` of the words (of short
   ones all).  So no copy is left out, and no paraphrase that is near in the latent space.
5. Candidates are checked: the longest common subsequence of words covers at least ``SAME`` of the
   benchmark passage, or at least ``PARAPHRASED`` of it and the answer, the passage's rarest
   words in its last sentence, is there too.

The benchmark is worked through in blocks of ``BLOCK_ITEMS`` items, so what tasks get is bounded
by the block.  Words are lower-cased and stand between ASCII characters
that are no letters, digits or underscores.  Items of fewer
than ``SHORT`` words must stand word by word in the text; items or texts that are null or
without words match nothing.  Repeated rows give one finding per doc_id and item_id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.memory import returning
from millrace.scratch import keep

WINDOW = 64
STEP = WINDOW // 2
#: Least share of a benchmark passage's squared length that a passage's terms may add up to.
SHARE = 0.5
COSINE = 0.4
SAME = 0.8
PARAPHRASED = 0.5
SHORT = 8
RANK = 256
OVERSAMPLING = 16
BLOCK_ITEMS = 1000
SEED = 2
#: Words of the answer, and how many of them have to be there.
ANSWER = 4
ANSWERED = 3
#: Terms in a larger share of the passages than this say nothing of a passage's matter and
#: get the least weight.
COMMON = 0.05
LEAST = 0.02
#: ASCII but letters, digits and the underscore: what stands between words.
GAPS = bytes.maketrans(*(bytes(x) for x in zip(*((c, 32) for c in range(128) if not (chr(c).isalnum() or c == 95)))))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(GAPS).split()


class Query(NamedTuple):
    """A benchmark passage."""

    item: int
    words: list[bytes]
    last: list[bytes]  # of its last sentence


def queries(items: list[tuple[int, str | None]]) -> list[Query]:
    out = []
    for item, text in items:
        text = text or ""
        own = words(text)
        for i in range(0, len(own), WINDOW):
            part = own[i:i + WINDOW]
            if i and len(part) < WINDOW // 2:  # a short rest goes with the words before it
                part = own[-WINDOW:]
            tail = words(re.split(r"[.!?\n]+\s*", text.rstrip(" .!?\n"))[-1])
            out.append(Query(item, part, tail if i + WINDOW >= len(own) else part))
    return out


def passages(ids: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Of a text's words as term numbers (-1: no term): passage, term and count of every term in
    every passage; words without a term per passage; how many passages there are."""
    n = max(1, -(-(len(ids) - STEP) // STEP))
    step = np.arange(len(ids)) // STEP
    both = np.concatenate([step, step - 1])  # each stretch of STEP words lies in two passages
    twice = np.concatenate([ids, ids])
    inside = (both >= 0) & (both < n)
    both, twice = both[inside], twice[inside]
    known = twice >= 0
    other = np.bincount(both[~known], minlength=n)
    pair, count = np.unique(both[known] * terms + twice[known], return_counts=True)
    return pair // terms, pair % terms, count, other, n


def lcs(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, by bits."""
    at: dict[bytes, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & at.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


class Needs(NamedTuple):
    """What the check asks of the distinct words around a passage, by benchmark passage (columns)."""

    words: np.ndarray  # terms x passages: whether the term is in it
    answer: np.ndarray  # the same of its answer
    same: np.ndarray  # least number of its distinct words, without the answer
    paraphrased: np.ndarray  # with it
    answered: np.ndarray  # least number of the answer's words

    @classmethod
    def of(cls, queries: list[Query], answers: list[list[bytes]], term: dict[bytes, int]) -> Needs:
        inside, answer = (np.zeros((len(term), len(queries)), np.int16) for _ in range(2))
        for i, (q, a) in enumerate(zip(queries, answers)):
            inside[[term[w] for w in q.words], i] = 1
            answer[[term[w] for w in a], i] = 1
        size, distinct = np.array([len(q.words) for q in queries]), inside.sum(axis=0)
        # a distinct word that is missing takes one word at least from the common subsequence
        same, paraphrased = (distinct - (size - np.ceil(share * size - 1e-9).astype(int)) for share in (SAME, PARAPHRASED))
        short = size < SHORT
        return cls(inside, answer, np.where(short, distinct, same), np.where(short, distinct, paraphrased),
                   np.array([min(ANSWERED, len(a)) for a in answers]))

    def met(self, ids: np.ndarray, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Benchmark passages (of some) that the distinct terms among ``ids`` do not rule out, and those of
        them whose words alone may be enough."""
        own = np.unique(ids)
        own = own[own >= 0]
        at = own if of is None else np.ix_(own, of)
        some = slice(None) if of is None else of
        words = self.words[at].sum(axis=0, dtype=np.int16)
        half = words >= self.paraphrased[some]
        if not half.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        answered = self.answer[at].sum(axis=0, dtype=np.int16) >= self.answered[some]
        alone = (words > 0) & (words >= self.same[some])
        found = tuple(np.flatnonzero(x) for x in ((words > 0) & half & answered | alone, alone))
        return found if of is None else (of[found[0]], of[found[1]])


class Model(NamedTuple):
    """What tasks need of a block of the benchmark."""

    queries: list[Query]
    term: dict[bytes, int]
    idf: np.ndarray
    other: float  # weight of a word without a term
    rows: np.ndarray  # the benchmark passages in the term space
    norms: np.ndarray
    axes: np.ndarray  # terms x latent dimensions
    needs: Needs

    def weights(self, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        return (1 + np.log(count)) * self.idf[term]


def _frequencies(texts: DataFrame, term: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """In how many passages of the corpus each term is, and how many passages there are."""
    number = len(term)
    shared = texts.sparkSession.sparkContext.broadcast(term)

    @returning
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(number + 1, np.int64)
        get = shared.value.get
        for batch in batches:
            for text in batch.column(0):
                own = words(text.as_py())
                if own:
                    ids = np.fromiter(map(get, own, repeat(-1)), np.int64, len(own))
                    _, t, _, _, n = passages(ids, number)
                    total[:-1] += np.bincount(t, minlength=number)
                    total[-1] += n
        at = np.flatnonzero(total)
        yield pa.record_batch({"term": at, "n": total[at]})

    out = np.zeros(number + 1, np.int64)
    for r in texts.mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    return out[:-1], int(out[-1])


KEPT = pa.schema([("doc_id", pa.int64()), ("body", pa.int64()), ("region", pa.binary()), ("terms", pa.list_(pa.int64())),
                  ("counts", pa.list_(pa.int64())), ("norm", pa.float64()), ("sure", pa.list_(pa.int32()))])


def _kept(docs: DataFrame, shared) -> DataFrame:
    """Stored: doc_id, body, region, terms, counts, norm, sure of the passages worth a search.  The
    region is the passage with half a passage on either side; ``sure`` are the benchmark passages of
    which it may hold ``SAME`` of the words."""
    @returning
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        get, number = model.term.get, len(model.term)
        # of the benchmark passage's squared length, or of the product of both if this one is shorter
        most = (model.rows / model.norms[:, None] ** 2).max(axis=0), (model.rows / model.norms[:, None]).max(axis=0)
        # some hundred texts at a time
        for part in (batch.slice(i, 256) for batch in batches for i in range(0, batch.num_rows, 256)):
            out = []
            for doc, body, text in zip(*(c.to_pylist() for c in part.columns)):
                own = words(text)
                if not own:
                    continue
                ids = np.fromiter(map(get, own, repeat(-1)), np.int64, len(own))
                passage, term, count, other, n = passages(ids, number)
                weight = model.weights(term, count)
                norm = np.sqrt(np.bincount(passage, weight ** 2, n) + other * model.other ** 2)
                # what one benchmark passage can add to the product with this one, at most
                shorter = np.bincount(passage, weight * most[0][term], n)
                longer = np.bincount(passage, weight * most[1][term], n)
                good = (shorter >= SHARE - 1e-9) | (longer >= SHARE * norm - 1e-9)
                good &= norm > 0
                sure, maybe = {}, model.needs.met(ids)[0]   # of the whole text, then of each region
                if len(maybe):
                    for i in range(n):
                        some, alone = model.needs.met(ids[max(0, (i - 1) * STEP):(i + 3) * STEP], maybe)
                        if len(some):
                            sure[i], good[i] = alone.tolist(), True
                if not good.any():
                    continue
                edges = np.searchsorted(passage, np.arange(n + 1))
                for i in np.flatnonzero(good).tolist():
                    a, b = edges[i], edges[i + 1]
                    out.append({"doc_id": doc, "body": body, "region": b" ".join(own[max(0, (i - 1) * STEP):(i + 3) * STEP]),
                                "terms": term[a:b].tolist(), "counts": count[a:b].tolist(), "norm": float(norm[i]), "sure": sure.get(i, [])})
            if out:
                yield pa.RecordBatch.from_pylist(out, KEPT)

    return keep(docs.mapInArrow(kept, "doc_id long, body long, region binary, terms array<long>, counts array<long>, norm double, sure array<int>"), "passages")


def _dense(model: Model, rows: pa.RecordBatch | pd.DataFrame, norms: np.ndarray) -> np.ndarray:
    """Rows of unit length in the full space, as far as they lie in the term space."""
    out = np.zeros((len(norms), len(model.term)), np.float32)
    for i, (t, c) in enumerate(zip(rows["terms"], rows["counts"])):
        t = np.asarray(t, np.int64)
        out[i, t] = model.weights(t, np.asarray(c)) / norms[i]
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-30)


SUMS = "n long, total binary"


def _sums(kept: DataFrame, shared, factor: np.ndarray) -> DataFrame:
    """n, total: of some kept passages each, the sum of row-transposed times row times ``factor``.  A sum has the
    size of the sketch, so there are no more of them than cores, however many files the passages are in."""
    size = kept.sparkSession.sparkContext.broadcast(factor.astype(np.float32))
    shape = factor.shape

    @returning
    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(shape), 0
        for frame in frames:
            for i in range(0, len(frame), 256):
                some = frame.iloc[i:i + 256]
                a = _dense(shared.value, some, some["norm"].to_numpy())
                total += a.T @ (a @ size.value)
                n += len(some)
        if n:
            yield pd.DataFrame([{"n": n, "total": total.tobytes()}])

    return kept.select("terms", "counts", "norm").coalesce(kept.sparkSession.sparkContext.defaultParallelism).mapInPandas(part, SUMS)


def _gram(kept: DataFrame, shared, factor: np.ndarray) -> tuple[np.ndarray, int]:
    """Mean over the kept passages of row-transposed times row times ``factor``."""
    shape = factor.shape

    def added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(shape), 0
        for frame in frames:
            for k, data in zip(frame["n"], frame["total"]):
                total += np.frombuffer(data).reshape(shape)
                n += k
        if n:
            yield pd.DataFrame([{"n": n, "total": total.tobytes()}])

    some = kept.sparkSession.sparkContext.defaultParallelism // 8 + 1
    row = _sums(kept, shared, factor).repartition(some).mapInPandas(added, SUMS).repartition(1).mapInPandas(added, SUMS).first()
    return (np.frombuffer(row.total).reshape(shape), row.n) if row else (np.zeros(shape), 0)


def _axes(kept: DataFrame, shared, model: Model) -> np.ndarray:
    """Leading right singular vectors of the kept passages and the benchmark's."""
    rank = min(RANK, len(model.term))
    own = model.rows / model.norms[:, None]

    def times(factor: np.ndarray) -> np.ndarray:
        total, n = _gram(kept, shared, factor)
        return own.T @ (own @ factor) / len(own) + total / max(n, 1)

    sketch = np.random.default_rng(SEED).standard_normal((len(model.term), min(rank + OVERSAMPLING, len(model.term))))
    basis, _ = np.linalg.qr(times(sketch))
    small = basis.T @ times(basis)
    value, vector = np.linalg.eigh((small + small.T) / 2)
    return basis @ vector[:, np.argsort(-value)[:rank]]


def _rarest(query: Query, term: dict[bytes, int], idf: np.ndarray) -> list[bytes]:
    return sorted(set(query.last), key=lambda w: (-idf[term[w]], w))[:ANSWER]


def judged(query: Query, answer: list[bytes], region: list[bytes]) -> tuple[float, bool, bool]:
    """Share of the passage in the longest common subsequence, whether the answer is there, and
    whether that makes a contamination."""
    share = lcs(query.words, region) / len(query.words)
    there = set(region)
    answered = sum(w in there for w in answer) >= min(ANSWERED, len(answer))
    if len(query.words) < SHORT:
        k = len(query.words)
        return share, answered, any(region[i:i + k] == query.words for i in range(len(region) - k + 1))
    return share, answered, share >= SAME or (share >= PARAPHRASED and answered)


def _found(kept: DataFrame, shared) -> DataFrame:
    @returning
    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model: Model = shared.value
        latent = _unit(model.rows @ model.axes)
        answers = [_rarest(q, model.term, model.idf) for q in model.queries]
        for frame in frames:
            for i in range(0, len(frame), 256):
                some = frame.iloc[i:i + 256]
                cosine = _unit(_dense(model, some, some["norm"].to_numpy()) @ model.axes) @ latent.T
                out = []
                regions = some["region"].tolist()
                near = cosine >= COSINE
                for p, sure in enumerate(some["sure"]):
                    near[p, np.asarray(sure, np.int64)] = True
                for p, q in zip(*np.nonzero(near)):
                    share, answered, hit = judged(model.queries[q], answers[q], bytes(regions[p]).split(b" "))
                    if hit:
                        row = some.iloc[p]
                        out.append((row["doc_id"], row["body"], model.queries[q].item, float(cosine[p, q]), share, answered))
                if out:
                    yield pd.DataFrame(out, columns=["doc_id", "body", "item_id", "cosine", "lcs", "answered"])

    return kept.mapInPandas(found, FOUND)


FOUND = "doc_id long, body long, item_id long, cosine double, lcs double, answered boolean"


def _block(docs: DataFrame, own: list[Query]) -> DataFrame:
    spark = docs.sparkSession
    term = {w: i for i, w in enumerate(sorted({w for q in own for w in (*q.words, *q.last)}))}
    frequency, total = _frequencies(docs.select("text"), term)
    idf = np.maximum(np.log((1 + total) / (1 + frequency)) + np.log(COMMON), LEAST)
    rows = np.zeros((len(own), len(term)))
    for i, q in enumerate(own):
        t, c = np.unique([term[w] for w in q.words], return_counts=True)
        rows[i, t] = (1 + np.log(c)) * idf[t]
    model = Model(own, term, idf, max(float(np.log(1 + total) + np.log(COMMON)), LEAST), rows, np.sqrt((rows * rows).sum(axis=1)), np.zeros((0, 0)),
                  Needs.of(own, [_rarest(q, term, idf) for q in own], term))
    shared = spark.sparkContext.broadcast(model)
    kept = _kept(docs, shared)
    return _found(kept, spark.sparkContext.broadcast(model._replace(axes=_axes(kept, shared, model))))


def find(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Stored: doc_id, body, item_id, cosine, lcs, answered of the contaminated documents, the
    best passage of each pair.  ``body`` tells apart the texts of rows that repeat a doc_id."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("body"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).where("text IS NOT NULL").distinct()
    found, block = None, []
    for row in (*items.orderBy("id", "text").toLocalIterator(), None):
        if row is not None:
            block += queries([(row.id, row.text)])
        if block and (row is None or len(block) >= BLOCK_ITEMS):
            part = _block(own, block)
            found, block = part if found is None else found.union(part), []
    if found is None:
        return docs.sparkSession.createDataFrame([], FOUND)
    best = F.max(F.struct("lcs", "cosine", "answered")).alias("best")
    return keep(found.groupBy("doc_id", "body", "item_id").agg(best).select(
        "doc_id", "body", "item_id", "best.cosine", "best.lcs", "best.answered"), "contaminated")


def clean(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones."""
    gone = found.select(F.col("doc_id").alias("__id"), F.col("body").alias("__body")).distinct()
    return docs.join(gone, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__body")), "left_anti")

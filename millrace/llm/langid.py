"""Language identification by rank order: the most frequent n-grams of a document, in the
order of their counts, are compared with each language's list by how far they stand out of
place.

n-grams are one to three characters of lower-cased words, with the word's ends marked.
Texts are taken whole.  A text that is null or has no letter is ``und`` with score 0, as is
every text if nothing could be learned.  Equal counts rank by the n-gram's code points,
equal distances go to the language that comes first in the alphabet.  Rows repeat as often
as they come in.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.memory import returning

UNDETERMINED = "und"
#: Length of the lists that are compared.
RANKS = 300
#: n-grams with counts that a task holds before it adds them up.
HELD = 1 << 20
#: Stands for a word's ends; no letter has this code.
EDGE = 1


@cache
def letters() -> np.ndarray:
    """Per code point whether it is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, ascending, and their counts.  An n-gram is its
    characters' code points, 21 bits each."""
    code = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le", "surrogatepass"), "<u4")
    code = np.where(letters()[code], code, EDGE).astype(np.int64)
    inner = code != EDGE
    code = code[np.r_[True, inner[1:] | inner[:-1]]]  # one end between words
    inner = code != EDGE
    one = code[inner]
    pair = (code[:-1] << 21) | code[1:]
    three = (pair[:-1] << 21) | code[2:]
    found = np.concatenate([one, pair, three[inner[1:-1]]])
    return np.unique(found, return_counts=True) if len(one) else (one, one)


def ranked(text: str | None, ranks: int = RANKS) -> np.ndarray:
    """The most frequent n-grams, most frequent first."""
    gram, count = grams(text)
    return gram[np.argsort(-count, kind="stable")[:ranks]]


def profiles(labelled: DataFrame, text: str, lang: str, ranks: int = RANKS) -> dict[str, list[int]]:
    """Per language its most frequent n-grams over all labelled rows.

    Tasks count on their own first.  What reaches the driver is ``ranks`` numbers for each
    language, so its size is bounded by the languages.
    """
    @returning
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        held = 0

        def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            every, n = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(every, kind="stable")
            every, n = every[order], n[order]
            first = np.flatnonzero(np.r_[True, np.diff(every) != 0])
            return every[first], np.add.reduceat(n, first)

        def out() -> Iterator[pa.RecordBatch]:
            for of, parts in waiting.items():
                gram, n = added(parts)
                yield pa.record_batch({"lang": pa.array([of] * len(gram), pa.string()), "gram": pa.array(gram, pa.int64()), "n": pa.array(n, pa.int64())})

        for batch in batches:
            for of, text in zip(batch.column(0), batch.column(1)):
                gram, n = grams(text.as_py())
                if not len(gram):
                    continue
                waiting.setdefault(of.as_py(), []).append((gram, n))
                held += len(gram)
                if held < HELD:
                    continue
                waiting = {of: [added(parts)] for of, parts in waiting.items()}
                held = sum(len(parts[0][0]) for parts in waiting.values())
                if held > HELD // 2:    # letters without end: hand on what there is
                    yield from out()
                    waiting, held = {}, 0
        yield from out()

    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = (
        labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
        .where("lang IS NOT NULL AND text IS NOT NULL")
        .mapInArrow(counted, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)
    )
    found: dict[str, list[int]] = {}
    for r in top.select("lang", "rank", "gram").orderBy("lang", "rank").toLocalIterator():
        found.setdefault(r.lang, []).append(r.gram)
    return found


def predictor(of: dict[str, list[int]], ranks: int = RANKS):
    """Column function: string -> struct of ``lang`` and ``score``.

    Distance: the sum over the document's n-grams of the difference of ranks, ``ranks``
    where the language's list has it not.  Score: one less its share of the largest
    possible distance.
    """
    langs = sorted(of)
    places = []
    for lang in langs:
        order = np.argsort(of[lang], kind="stable")
        places.append((np.array(of[lang], np.int64)[order], order))

    def judge(text: str | None) -> tuple[str, float]:
        gram = ranked(text, ranks)
        if not len(gram) or not langs:
            return UNDETERMINED, 0.0
        at = np.arange(len(gram))
        far = []
        for known, rank in places:
            i = np.minimum(np.searchsorted(known, gram), len(known) - 1)
            far.append(int(np.where(known[i] == gram, np.minimum(np.abs(rank[i] - at), ranks), ranks).sum()))
        best = int(np.argmin(far))
        return langs[best], 1 - far[best] / (ranks * len(gram))

    @returning
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [judge(t.as_py()) for t in batch]
            yield pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=["lang", "score"])

    return F.arrow_udf(predict, "lang string, score double")


def held_out(doc_id: str) -> Column:
    """Whether a document is kept from learning; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"):
    """Predictor from all labelled documents that are not held out."""
    return predictor(profiles(docs.where(~held_out(doc_id)), text, lang))

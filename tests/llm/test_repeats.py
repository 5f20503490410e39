"""Repeated substrings against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from millrace.llm import repeats
from millrace.llm.queries import QUERIES

END = 1 << 62


def brute(rows, length):
    """(doc_id, bytes kept) of (doc_id, text) rows."""
    first: dict[bytes, int] = {}
    rows = [(END if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in rows:
        for s in range(len(t) - length + 1):
            first[t[s:s + length]] = min(first.get(t[s:s + length], END), i)
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if first[t[s:s + length]] < i:
                gone[s:s + length] = b"\1" * length
        out.append((i, bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(out)


def run(df, length=repeats.LENGTH):
    return sorted((END if r.doc_id is None else r.doc_id, bytes(r.kept)) for r in repeats.dedup(df, length=length).collect())


def made(seed, alphabet, n=60):
    rng = random.Random(seed)
    pool = ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, 150))) for _ in range(8)]
    for _ in range(n):
        parts = [rng.choice([rng.choice(pool), rng.choice(pool)[rng.randint(0, 30):], "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))]) for _ in range(rng.randint(0, 5))]
        yield rng.randint(0, n), "".join(parts)


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh \n", "aé漢 "])
def test_against_brute_force(docs, alphabet):
    rows = list(made(3, alphabet))
    assert run(docs(rows).repartition(4)) == brute(rows, repeats.LENGTH)


def test_short_length(docs):
    rows = list(made(5, "abc ", 30))
    assert run(docs(rows).repartition(3), 9) == brute(rows, 9)


def test_nulls_repeats_and_long_texts(docs):
    line = "a passage of over fifty bytes that stands in several documents, "
    rows = [(1, line), (2, None), (3, ""), (None, line + "own"), (1, line), (4, "x" * 49), (5, "x" * 49), (6, "de " * 5000), (7, "de " * 3000 + line)]
    assert run(docs(rows).repartition(3)) == brute(rows, repeats.LENGTH)
    assert run(docs([])) == []


def test_document_over_several_pieces(docs, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 64)  # workers of local mode are forked with it
    block = repeats.Block([1, 2], [700, 90], __import__("zstandard").compress(random.Random(1).randbytes(790)))
    key, doc, start, end = block.segments(50)
    windows = sorted(w for s, e in zip(start, end) for w in range(s, e - 49))
    assert windows == [*range(651), *range(700, 741)]


def test_maximal_repeats_are_those_of_the_definition():
    text = b"abcabcabxabcab"
    words = [text[i:] for i in range(len(text))]
    of, offset, common, left = repeats.suffix_array(text, np.array([len(text)]), np.array([len(text)]), 2)
    found = {(text[offset[a]:offset[a] + p], tuple(sorted(offset[a:b].tolist()))) for a, b, p, _ in repeats.maximal_repeats(common, left, of, 2)}
    want = set()
    for i in range(len(text)):
        for p in range(2, len(text) - i):
            at = [j for j in range(len(text)) if words[j].startswith(text[i:i + p])]
            lefts = {text[j - 1:j] if j else b"^" for j in at}
            rights = {text[j + p:j + p + 1] or b"$%d" % j for j in at}
            if len(at) > 1 and len(lefts) > 1 and len(rights) > 1:
                want.add((text[i:i + p], tuple(at)))
    assert found == want


def test_query_against_brute_force(spark, sf_dir, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: r for r in QUERIES["op3_repeats"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for i, kept in brute(rows, 50):
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert got[i].n_bytes - got[i].n_removed == len(kept)

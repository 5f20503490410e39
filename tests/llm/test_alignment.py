"""Cross-tokenizer alignment against a brute-force version; fragments against whole texts."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import alignment
from millrace.llm.queries import BYTE_RANKS, PIECES, QUERIES
from millrace.llm.vocabularies import ByteBPE, contents

BYTES = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
BYTES.encode_special_tokens = True
MODEL = sentencepiece.SentencePieceProcessor(model_file=PIECES)
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def byte_alphabet() -> dict[str, int]:
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(moved)}


ALPHABET = byte_alphabet()


def tokens(text):
    """(id, bytes) lists of A and B, or None."""
    if not text:
        return None
    a = [(i, bytes(ALPHABET[c] for c in BYTES.id_to_token(i))) for i in BYTES.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in MODEL.encode(text):
        piece = MODEL.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if MODEL.is_byte(i) else piece.replace("▁", " ").encode()))
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else None


def ranges(side):
    at = 0
    for i, data in side:
        yield i, at, at + len(data)
        at += len(data)


def brute_text(text):
    """(n_a, n_b, groups, links) by comparing every token with its neighbours."""
    if (both := tokens(text)) is None:
        return 0, 0, [], []
    a, b = (list(ranges(x)) for x in both)
    common = sorted({e for *_, e in a} & {e for *_, e in b})
    groups = [([], []) for _ in common]
    for side, tokens_of in enumerate((a, b)):
        at = 0
        for i, _, e in tokens_of:
            groups[at][side].append(str(i))
            at += e == common[at]
    groups = [tuple(map(",".join, g)) for g in groups]
    links, j = [], 0
    for i, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            links.append((i, b[k][0]))
            k += 1
    return len(a), len(b), groups, links


def brute(rows):
    each = [(i, *brute_text(t)) for i, t in rows]
    counts = Counter(x for *_, links in each for x in links)
    best: dict[int, int] = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return sorted(
        (str(i), n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
         ";".join(f"{a}|{b}" for a, b in groups)) for i, n_a, n_b, groups, links in each)


def found(df):
    return sorted((str(r.doc_id), *(r[c] for c in COLUMNS)) for r in df.collect())


def align(spark, df, **more):
    return alignment.align(spark, df, BYTE_RANKS, public_tokenizers.PATTERN, PIECES, **more)


ODD = ["", None, " ", "\n\n", "x", " lead", "two  spaces   here ", "tab\tand\r\nline", "don't I'll we've", "naïve café 漢字、仮名。", "🙂🙃 zero‍width",
       "a ▁ literal", "<|endoftext|> <s> </s> <0x41> <unk>", "\x00nul\x1c\x85", "word" * 50, "9" * 40, "...!!!???" * 9, "x y", "x y", "﻿mark"]


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in brute(rows)]
    got = QUERIES["op13_alignment"](spark, sf_dir)
    assert sorted((str(r.doc_id), *(r[c] for c in COLUMNS[:-1]), r.groups_sha256) for r in got.collect()) == want


def test_odd_texts(spark, docs):
    rows = [(i if i % 3 else None, t) for i, t in enumerate(ODD)] + [(7, "two  spaces   here ")]
    df = docs(rows).withColumn("n_a", F.lit("clash")).withColumn("__row", F.lit(0))
    assert found(align(spark, df)) == brute(rows)
    assert align(spark, df.limit(0)).count() == 0


@pytest.mark.parametrize("chunk,fan,hot", [(7, 2, 3), (64, 3, 1 << 18), (300, 16, 5)])
def test_chunks_and_rare_pairs_change_nothing(spark, sf_dir, docs, chunk, fan, hot):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("n_chars < 700").collect()]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(5000, "a" * 900), (5001, "漢" * 500 + "。" + "字" * 300), (5002, " " * 800)]
    assert found(align(spark, docs(rows), chunk=chunk, fan=fan, hot=hot)) == brute(rows)


@pytest.fixture(scope="module")
def own():
    return alignment.Aligner(contents(BYTE_RANKS), public_tokenizers.PATTERN, contents(PIECES))


def shape(f):
    return f.valid, f.closed, f.n_groups, f.n_a, f.n_b, ";".join(f.groups), f.head.packed(), f.tail.packed(), sorted(np.concatenate([*f.pairs, [0]]).tolist())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([*"ab1,. \n'漢🙂", "the ", "don't ", "ing", "  "]), min_size=1, max_size=60).map("".join), st.integers(1, 9))
def test_composition_is_associative(own, text, size):
    parts = [own.fragment(*c) for c in own.chunks(text, size)]
    left = parts[0]
    for p in parts[1:]:
        left = alignment.composed(left, p, own.b.size)
    right = parts[-1]
    for p in parts[-2::-1]:
        right = alignment.composed(p, right, own.b.size)
    assert shape(left) == shape(right) == shape(own.fragment(" " + text, " " + text))


def test_long_runs_of_white_space(spark):
    ranks = ByteBPE(contents(BYTE_RANKS), public_tokenizers.PATTERN)
    for text in (" " * 120_000, "x" + " " * 120_000 + "y" + "\n" * 90_000, " 　" * 40_000 + "z", "a" + "\t" * 60_000 + "."):
        assert ranks.encode(text).tolist() == BYTES.encode(text, add_special_tokens=False).ids

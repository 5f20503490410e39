"""BPE against the tiktoken library, over texts and single characters; exact round trips."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import bpe
from millrace.llm.queries import QUERIES, RANKS


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def encode(ranks):
    return bpe.Encoder(ranks, bpe.PerfectHash(ranks), public_tokenizers.PATTERN).encode


@pytest.fixture(scope="module")
def twin(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_perfect_hash_is_minimal_and_exact(ranks):
    table = bpe.PerfectHash(ranks)
    assert None not in table.keys and len(table.keys) == len(ranks)
    assert all(table.get(k) == r for k, r in ranks.items())
    assert table.get(b"no such token at all") is None
    assert bpe.PerfectHash({}).get(b"a") is None


def test_merge_matches_the_library_piece_by_piece(ranks, twin):
    for piece in ("aaaaaaaa", "abababab", "ing" * 50, "ß€漢字", "\u0000\u0001", "x" * 3000):
        assert bpe.merge(piece.encode(), ranks) == twin._encode_single_piece(piece.encode()) or len(piece) == 1


def test_generations_forget_and_change_nothing(ranks, twin):
    few = bpe.Encoder(ranks, bpe.PerfectHash(ranks), public_tokenizers.PATTERN, remembered=3)
    text = "some words come again and others not, some words do; zqxv zqxv again zqxv others"
    for _ in range(3):
        assert ids(few.encode(text)) == twin.encode_ordinary(text)
    assert len(few.young) <= 3 and len(few.old) <= 3


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"])))
def test_texts(encode, twin, text):
    assert ids(encode(text)) == twin.encode_ordinary(text)


def test_columns_and_round_trip(spark, docs, ranks):
    texts = ["", None, "one two  three\n\n four", "<|endoftext|>", "the " * 20000, "it's I'LL\t x"]
    rows = docs(enumerate([*texts, texts[2]])).withColumn("ids", F.lit("clash"))
    encode, decode = bpe.encoder(spark, RANKS, public_tokenizers.PATTERN), bpe.decoder(spark, RANKS)
    out = rows.select("doc_id", "text", encode("text").alias("ids")).withColumn("back", decode("ids")).collect()
    assert len(out) == 7
    assert all(bytes(r.back) == (r.text or "").encode() for r in out)
    assert rows.limit(0).select(encode("text")).count() == 0


def test_query_against_the_library(spark, sf_dir, documents, twin):
    import hashlib

    got = {r.doc_id: r for r in QUERIES["op6_bpe"](spark, sf_dir).collect()}
    for r in documents.collect():
        want = np.array(twin.encode_ordinary(r.text or ""), "<u4")
        own = got[r.doc_id]
        assert (own.n_tokens, own.ids_sha256) == (len(want), hashlib.sha256(want.tobytes()).hexdigest())
        assert own.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_places_of_long_pieces_do_not_run_into_ranks():
    tiny = {bytes([c]): i for i, c in enumerate(b"ab")} | {b"ab": 2, b"abab": 3}
    pairs = bpe.byte_pairs(tiny)
    assert [pairs[c] for c in (0x6162, 0x6261, 0x6161)] == [2, -1, -1]
    for n in (1, 2, (1 << bpe.PLACE - 1) - 1, 1 << bpe.PLACE - 1, (1 << bpe.PLACE) + 3):
        assert bpe.merge(b"ab" * n, tiny, pairs) == bpe.merge(b"ab" * n, tiny) == [3] * (n // 2) + [2] * (n % 2)
    assert bpe.merge(b"bba", tiny, pairs) == [1, 1, 0]


def test_a_worker_hands_on_slice_by_slice(spark):
    """A batch of long texts is not held a second time as ids and a third time as decoded bytes."""
    import pyarrow as pa

    texts = ["one two three " * 100_000, None, "x " * 1_000_000, "", "four five " * 300_000, "six " * 1_000_000]
    batch = pa.array(texts)
    both = list(bpe.round_trip(spark, RANKS, public_tokenizers.PATTERN).func(iter([batch, batch.slice(0, 0)])))
    assert len(both) > 3 and [len(p) for p in both][-1] == 0
    assert [x["decoded"].decode() for p in both for x in p.to_pylist()] == [t or "" for t in texts]
    assert max(p.field("decoded").nbytes for p in both) < batch.nbytes / 2
    again = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    out = again.select("i", bpe.round_trip(spark, RANKS, public_tokenizers.PATTERN)("t").alias("x")).select("i", "x.decoded").collect()
    assert {r.i: bytes(r.decoded).decode() for r in out} == {i: t or "" for i, t in enumerate(texts)}

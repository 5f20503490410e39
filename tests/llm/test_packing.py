"""Packing along the curve: every id in one piece, sequences full, like documents together."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm.queries import BYTE_RANKS, QUERIES

BYTES = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def pack(spark, df, capacity=2048):
    return packing.pack(spark, df, BYTE_RANKS, public_tokenizers.PATTERN, {"<|endoftext|>": 50256}, 1, capacity)


def ids_of(text):
    return [*BYTES.encode(text or "", add_special_tokens=False).ids, 1]


def sequences(rows):
    """Length of each sequence; pieces must lie in it without gap."""
    out = {}
    for s, pieces in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for p in pieces:
            assert p.offset == at and p.length > 0
            at += p.length
        out[s] = at
    assert sorted(out) == list(range(len(out)))
    return out


def no_padding(lengths, capacity):
    full = sum(lengths.values()) // capacity
    return all(n == (capacity if s < full else n & -n) for s, n in lengths.items()) and len(lengths) <= full + capacity.bit_length()


def test_query_holds_every_id_once(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op12_packing"](spark, sf_dir).collect()
    assert no_padding(sequences(rows), 2048)
    by = {d: sorted(p, key=lambda r: r.start) for d, p in itertools.groupby(sorted(rows, key=lambda r: r.doc_id), key=lambda r: r.doc_id)}
    assert by.keys() == texts.keys()
    for d, pieces in by.items():
        ids = np.array(ids_of(texts[d]), "<u4")
        assert sum(p.length for p in pieces) == len(ids) == pieces[0].doc_tokens
        at = 0
        for p in pieces:
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length


def test_odd_rows(spark, docs):
    texts = ["", None, " ", "same", "same", "same", "a <|endoftext|> b<|endoftext|>", "漢字 🙂\x00", "word " * 9000, "x" * 5000]
    df = docs([(i if i != 3 else None, t) for i, t in enumerate(texts)] + [(5, "same")]).withColumn("n", F.lit("clash")).withColumn("__row", F.lit(1))
    rows = pack(spark, df, 256).collect()
    assert no_padding(sequences(rows), 256)
    want = sorted(np.array(ids_of(t), "<u4").tobytes() for t in [*texts, "same"])
    got, runs = [], sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    for r in runs:
        got = [*got, bytes(r.ids)] if r.start == 0 else [*got[:-1], got[-1] + bytes(r.ids)]
    assert sorted(got) == want
    assert pack(spark, df.limit(0)).collect() == []


def test_hot_place_spans_ranges(spark, docs):
    df = docs([(i, "copy") for i in range(3000)] + [(i, f"other {i} text") for i in range(3000, 4000)]).repartition(8)
    rows = pack(spark, df).collect()
    assert len({r.doc_id for r in rows}) == 4000 and no_padding(sequences(rows), 2048)


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2), (2, 1)])
def test_hilbert_visits_neighbours(dimensions, bits):
    grid = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    index = packing.hilbert(grid, bits)
    assert sorted(index.tolist()) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("total,capacity", [(0, 8), (7, 8), (8, 8), (29, 8), (2047, 2048), (5000, 1024)])
def test_rest_is_powers_of_two(total, capacity):
    found = packing.pieces_of(0, total, capacity, packing.rest(total, capacity))
    assert sum(p[1] for p in found) == total
    assert [p[2] for p in found] == list(range(len(found))) and all(p[3] == 0 for p in found)
    assert all(p[1] == capacity for p in found[:total // capacity]) and all(p[1] & (p[1] - 1) == 0 for p in found)


def test_like_documents_are_neighbours(spark, docs):
    words = [["river", "bank", "water", "boat", "fish"], ["stock", "price", "market", "trade", "fund"], ["cell", "gene", "protein", "blood", "tissue"]]
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.choice(words[i % 3], 60))) for i in range(300)]
    found = sorted(pack(spark, docs(rows)).where("start = 0").collect(), key=lambda r: (r.sequence_id, r.offset))
    topics = [r.doc_id % 3 for r in found]
    changes = sum(a != b for a, b in zip(topics, topics[1:]))
    assert changes < 40  # 200 in random order

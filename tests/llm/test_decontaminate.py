"""Decontamination: every planted passage is found, texts without one are not."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate as dc
from millrace.llm.queries import QUERIES

ITEM = "The brass lantern swung above the harbour wall while grey boats waited for the morning tide. Which keeper lit the northern beacon first?"
PARA = "A brass lantern swung above the old harbour wall and some grey boats waited for a morning tide, so which keeper lit the far northern beacon first"
OTHER = "Seventeen engineers measured pressure inside copper pipes until winter closed the mountain road. Where did the copper finally crack?"


@pytest.fixture
def items(spark):
    def make(rows):
        return spark.createDataFrame(rows, "item_id long, text string")

    return make


def filler(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "and", "to", "in"]) if rng.random() < 0.4 else "".join(rng.choice("bcdfgl") + rng.choice("aeiou") for _ in range(3)) for _ in range(n))


def hits(found):
    return {(r.doc_id, r.item_id) for r in found.collect()}


def test_as_many_sums_as_cores(spark):
    """A sum has the size of the sketch: one for each of many small files would fill the disks."""
    model = dc.Model([], {b"a": 0, b"b": 1}, np.ones(2), 1.0, np.zeros((0, 2)), np.zeros(0), np.zeros((0, 0)), None)
    kept = spark.range(640).select(F.array(F.col("id") % 2).alias("terms"), F.array(F.lit(1)).alias("counts"), F.lit(2.0).alias("norm"))
    shared = spark.sparkContext.broadcast(model)
    sums = dc._sums(kept.repartition(64), shared, np.eye(2)).collect()
    assert len(sums) <= spark.sparkContext.defaultParallelism and sum(r.n for r in sums) == 640
    total, n = dc._gram(kept.repartition(64), shared, np.eye(2))
    assert n == 640 and total.tolist() == [[80.0, 0.0], [0.0, 80.0]]


def test_subsequence():
    assert dc.lcs(b"a b c d".split(), b"x a y c d b".split()) == 3
    assert dc.lcs([], [b"a"]) == 0 == dc.lcs([b"a"], [])
    rng = random.Random(1)
    for _ in range(50):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in range(2))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        assert dc.lcs(a, b) == t[-1, -1]


@pytest.mark.parametrize("n", [1, 31, 32, 33, 64, 65, 200])
def test_passages_cover_every_word_twice_at_most(n):
    ids = np.arange(n)
    passage, term, count, other, many = dc.passages(ids, n)
    assert set(term.tolist()) == set(range(n)) and not other.any() and (count == 1).all()
    for p in range(many):
        own = term[passage == p]
        assert own.tolist() == list(range(p * dc.STEP, min(n, p * dc.STEP + dc.WINDOW)))


def test_copies_paraphrases_and_clean_texts(docs, items):
    rows = [(i, filler(i, 300)) for i in range(20)]
    rows += [(100, f"{filler(50, 211)} {ITEM} {filler(51, 70)}"), (101, f"{filler(52, 40)}\n{PARA.upper()}\n{filler(53, 90)}"), (102, ITEM),
             (103, " ".join(sorted(ITEM.split()))), (104, ITEM[:40] + filler(54, 60)), (105, f"{filler(55, 12)} {OTHER}")]
    found = dc.find(docs(rows).withColumn("region", F.lit("clash")), items([(1, ITEM), (2, OTHER)]))
    assert hits(found) == {(100, 1), (101, 1), (102, 1), (105, 2)}


def test_odd_rows(docs, items):
    bench = items([(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "blue whale"), (None, OTHER)])
    rows = [(1, None), (2, ""), (3, "a blue whale sings"), (4, "whale so blue"), (None, ITEM), (5, ITEM), (5, ITEM), (5, filler(1, 50)), (6, filler(2, 30000) + " " + ITEM), (7, OTHER)]
    found = dc.find(docs(rows), bench)
    assert hits(found) == {(3, 4), (None, 1), (5, 1), (6, 1), (7, None)}
    clean = dc.clean(docs(rows).withColumn("body", F.lit("clash")), found)
    assert sorted(((r.doc_id, (r.text or "")[:20]) for r in clean.collect()), key=str) == sorted([(1, ""), (2, ""), (4, "whale so blue"), (5, filler(1, 50)[:20])], key=str)
    assert hits(dc.find(docs([]), bench)) == set() == hits(dc.find(docs(rows), items([])))


def test_long_items_are_found_by_any_of_their_passages(docs, items):
    long = filler(9, 400)
    part = " ".join(long.split()[200:270])
    assert hits(dc.find(docs([(1, filler(1, 100) + " " + part), (2, filler(2, 300))]), items([(1, long)]))) == {(1, 1)}


def test_pairs_that_meet_the_check_are_found_whatever_their_weight(docs, items):
    """Common words weigh next to nothing, yet they make up most of the passage; against all regions by brute force."""
    plain = [["the", "of", "and", "to", "in"][i * i % 5] for i in range(24)]
    bench = [(1, " ".join([*plain, "quarzil", "xendor", "plomvik"])), (2, ITEM)]
    rows = [(i, filler(i, 200)) for i in range(30)] + [(100, f"{filler(60, 90)} {' '.join(plain)} {filler(61, 90)}"), (101, " ".join(plain)), (102, f"{PARA} {filler(62, 99)}")]
    # no answer is in a text without its rare words, so the share alone decides there
    want = set()
    for doc, text in rows:
        own = dc.words(text)
        for item, passage in bench:
            q = dc.words(passage)
            most = max(dc.lcs(q, own[max(0, i - dc.STEP):i + 3 * dc.STEP]) for i in range(0, len(own), dc.STEP)) / len(q)
            if most >= dc.SAME or (item == 2 and most >= dc.PARAPHRASED):
                want.add((doc, item))
    assert {(100, 1), (101, 1), (102, 2)} <= want
    assert hits(dc.find(docs(rows), items(bench))) == want


def test_blocks_of_the_benchmark(docs, items, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 1)
    assert hits(dc.find(docs([(1, ITEM), (2, OTHER), (3, filler(1, 80))]), items([(1, ITEM), (2, OTHER)]))) == {(1, 1), (2, 2)}


def test_query_finds_what_holds_an_item(spark, sf_dir, documents):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {(r.doc_id, i) for r in documents.collect() for i, t in bench if t in (r.text or "")}
    assert hits(QUERIES["op2_latent"](spark, sf_dir)) == want and want

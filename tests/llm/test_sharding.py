"""Sharding: the law, the slots, and fewer cut links than chance."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import sharding
from millrace.llm.numbering import numbered
from millrace.llm.queries import QUERIES


def lawful(rows, shards):
    """Whether counts differ by one at most and slots are gapless."""
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(shards)}
    sizes = [len(x) for x in slots.values()]
    return sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1 and all(x == list(range(len(x))) for x in slots.values())


def placed(spark, n, pairs, shards):
    links = spark.createDataFrame(pairs, "a long, b long")
    out = sharding.assign(spark.range(n).withColumnRenamed("id", "node"), links, shards)
    return out, links


@pytest.mark.parametrize("n, shards", [(0, 4), (3, 5), (1000, 7)])
def test_without_links(spark, n, shards):
    out, _ = placed(spark, n, [], shards)
    assert lawful(out.collect(), shards)


def test_groups_meet(spark):
    pairs = [(10 * g, 10 * g + k) for g in range(60) for k in range(1, 8)]
    out, links = placed(spark, 1000, pairs, 8)
    assert lawful(out.collect(), 8)
    r = sharding.cut(links, out).first()
    assert r.links == len(pairs) and r.cut <= 0.02 * r.links  # 7 of 8 by chance


def test_pairs_meet_where_there_is_room(spark):
    pairs = [(2 * g, 2 * g + 1) for g in range(200)]
    out, links = placed(spark, 2000, pairs, 24)
    assert lawful(out.collect(), 24)
    assert sharding.cut(links, out).first().cut == 0


def test_ring_of_cliques(spark):
    rng = random.Random(1)
    pairs = [(g * 10 + i, g * 10 + j) for g in range(40) for i in range(10) for j in range(i)] + [(g * 10, rng.randrange(400)) for g in range(40)]
    out, links = placed(spark, 400, pairs, 4)
    assert lawful(out.collect(), 4)
    r = sharding.cut(links, out).first()
    assert r.cut < 0.5 * r.links  # 3 of 4 by chance


def test_a_group_larger_than_a_shard(spark):
    out, _ = placed(spark, 300, [(0, k) for k in range(1, 200)], 6)
    assert lawful(out.collect(), 6)


def test_numbers_within_keys(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 AS k")
    got = numbered(df, "k", "id", "n", 200_000).collect()  # eleven buckets
    for k in range(3):
        assert sorted(r.n for r in got if r.k == k) == list(range(sum(1 for r in got if r.k == k)))


def test_texts_with_nulls_and_repeats(docs):
    rows = [(1, "a"), (1, "a"), (None, "a"), (2, None), (3, ""), (4, "é" * 9)]
    df = sharding.equal_texts(docs(rows).withColumn("size", F.lit("clash")).withColumn("digest", F.lit(1)).withColumn("node", F.lit(None).cast("string")))
    got = sorted(((r.doc_id, r.size, r.text_crc32) for r in df.collect()), key=str)
    crc = lambda t: zlib.crc32((t or "").encode())
    assert got == sorted([(i, len((t or "").encode()) + 8, crc(t)) for i, t in rows], key=str)
    assert sharding.star_links(df, "node", "digest").count() == 3
    out = sharding.assign(df.select("node"), sharding.star_links(df, "node", "digest"), 24)
    assert lawful(out.collect(), 24)


def test_query(spark, sf_dir, documents):
    rows = QUERIES["op9_propagation"](spark, sf_dir).collect()
    text = {r.doc_id: (r.text or "").encode() for r in documents.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text) and lawful(rows, 24)
    assert all((r.size, r.text_crc32, r.law, r.grown_shard) == (len(text[r.doc_id]) + 8, zlib.crc32(text[r.doc_id]), "rows", None) for r in rows)
    groups = Counter(text.values())
    whole = sum(len({r.shard for r in rows if text[r.doc_id] == t}) == 1 for t, n in groups.items() if 1 < n)
    assert whole == sum(n > 1 for n in groups.values())

"""SimHash groups against brute force."""

from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.components import components
from millrace.llm.queries import QUERIES


def plain(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate(dict.fromkeys([9, 10, 11, 12, 13], " ")).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(prints, radius=3):
    """Smallest reachable id of each (id, fingerprint)."""
    top = {i: i for i, _ in prints}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for k, (i, a) in enumerate(prints):
        for j, b in prints[:k]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(i), find(j)))
                top[y] = x
    return {i: find(i) for i in top}


@pytest.mark.parametrize("text", ["", None, "one", "One TWO", "a b c", "A  b\tc\nd É é ß", "x y z w", "to be or not " * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain(text)


def test_spark_has_the_same_hash(spark):
    assert spark.sql("SELECT xxhash64('a b c') AS h").first().h % (1 << 64) == simhash.fingerprint("a b c")


def test_tree_finds_all_within():
    rng = random.Random(1)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values[:50]:
        assert {tree.values[i] for i in tree.within(v, 3)} == {x for x in values if (x ^ v).bit_count() <= 3}
    assert list(simhash.BKTree().within(5, 3)) == []


def test_links_join_what_brute_force_joins(spark):
    rng = random.Random(3)
    prints = []
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            prints.append(base)
            for bit in rng.sample(range(64), rng.randint(0, 3)):
                base ^= 1 << bit
    prints = sorted(set(prints))
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "id long, fp long")
    tops = {r.node: r.top for r in components(simhash.links(nodes)).collect()}
    of = dict((p, i) for i, p in rows)
    want = brute(list(enumerate(prints)))
    groups, own = {}, {}
    for p, i in of.items():
        groups.setdefault(want[i], set()).add(i)
        own.setdefault(tops.get(p, p), set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, own.values()))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(200, 100 + i) for i in range(50)]
    got = {r.node: r.top for r in components(spark.createDataFrame([*chain, *star, (7, 7), (3, 2)], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_first_of_groups_is_the_least_of_each_component(docs):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(900)]
    rows = [(g * 100, " ".join(rng.choice(words) for _ in range(300))) for g in range(30)]
    for i, text in list(rows):
        for k in range(1, 4):
            own = text.split(" ")
            own[rng.randrange(300)] = rng.choice(words)
            rows.append((i + k, " ".join(own)))
    rng.shuffle(rows)
    want = brute(sorted((i, plain(t)) for i, t in rows))
    left = {r.doc_id for r in simhash.first_of_groups(docs(rows)).collect()}
    assert left == set(want.values()) and {g * 100 for g in range(30)} <= left and len(left) < 90


def test_search_ends_early_and_joins_all(spark):
    rng = random.Random(9)
    values = list({sum(1 << b for b in rng.sample(range(64), 4)) for _ in range(500)})
    of = {v: i for i, v in enumerate(values)}
    found = simhash.shard_links(values, 6)
    want = brute(list(enumerate(values)), 6)
    top = list(range(len(values)))
    for a, b in found:
        x, y = top[of[a]], top[of[b]]
        top = [min(x, y) if t in (x, y) else t for t in top]
    assert top == [want[i] for i in range(len(values))] and len(found) < len(values)


def test_nulls_repeats_and_empties(docs):
    rows = [(5, "same words here and there"), (5, "same words here and there"), (2, "same words here and there"), (None, "same words here and there"),
            (7, None), (8, ""), (9, " \n"), (None, "quite other words stand here"), (3, "x " * 5000)]
    df = docs(rows).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(1))
    got = [(r.doc_id, r.component_id) for r in simhash.groups(df).collect()]
    assert sorted(got, key=str) == sorted([(5, 2), (5, 2), (2, 2), (None, 2), (7, 7), (8, 7), (9, 7), (None, None), (3, 3)], key=str)
    firsts = simhash.first_of_groups(df)
    assert firsts.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in firsts.collect()), key=str) == sorted([rows[2], rows[4], rows[7], rows[8]], key=str)
    assert simhash.groups(docs([])).collect() == [] == simhash.first_of_groups(docs([])).collect()


def test_query_against_brute_force(spark, sf_dir, documents):
    prints = [(r.doc_id, plain(r.text)) for r in documents.collect()]
    want = brute(sorted(prints))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op10_simhash"](spark, sf_dir).collect()}
    assert got == {i: (f"{p:016x}", want[i]) for i, p in prints}

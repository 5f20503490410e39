"""Line templates: a plain version in Python, and the cases of the contract."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import linededup as ld


def tokens(line):
    even = re.sub("[ \t\r\f\x0b]+", " ", line).strip(" ")
    return tuple(re.sub("[^ ]*[0-9][^ ]*", ld.FIELD, even).split(" "))


def split(group, levels):
    """The groups of a list of distinct lines (tuples of one length) after so many splits."""
    if not levels:
        return [group]
    n = len(group)
    at = [Counter(t[i] for t in group) for i in range(len(group[0]))]
    enough = lambda k: k >= 2 and k >= ld.SHARE * n
    best = max(range(ld.LEADING, len(at)), key=lambda i: (max(at[i].values()) if enough(max(at[i].values())) and max(at[i].values()) < n else 0, -i))
    top = max(at[best].values())
    if not enough(top) or top == n:
        return [group]
    parts = defaultdict(list)
    for t in group:
        parts[t[best] if enough(at[best][t[best]]) else None].append(t)
    return [g for p in parts.values() for g in split(p, levels - 1)]


def plain(rows):
    """Texts after the drop, for (doc_id, text) rows."""
    distinct = {t for _, x in rows if x is not None for t in map(tokens, x.split("\n")) if t != ("",)}
    leaves = defaultdict(list)
    for t in sorted(distinct):
        if len(t) > ld.LEADING:
            leaves[len(t), t[:ld.LEADING]].append(t)
    general = {}
    for leaf in leaves.values():
        for group in split(leaf, ld.LEVELS) if len(leaf) > 1 else ():
            kept = tuple(w[0] if len(set(w)) == 1 else None for w in zip(*group))
            if len(group) > 1 and sum(w is not None for w in kept) >= ld.SIMILARITY * len(kept):
                general |= {t: ("general", kept) for t in group}

    def templates(line):
        t = tokens(line)
        return [] if t == ("",) else [t, general[t]] if t in general else [t]

    docs = defaultdict(set)
    for i, x in rows:
        for y in (x or "").split("\n"):
            for k in templates(y):
                docs[k].add(i)
    need = lambda k: 2 if k[0] != "general" and len(k) >= ld.LONG else ld.MIN_DOCS
    first = {k: min((i for i in v if i is not None), default=None) for k, v in docs.items() if len(v) >= need(k)}
    out = []
    for i, x in rows:
        own = [] if x is None else [y for y in x.split("\n") if all(first.get(k, i) == i for k in templates(y))]
        out.append((i, None if x is None else "\n".join(own)))
    return sorted(out, key=str)


def run(df):
    return sorted(((r.doc_id, r.text) for r in ld.dedup(df).collect()), key=str)


def test_against_plain_python(docs):
    rng = random.Random(2)
    frames = ["user {} logged in from host {} today", "job {} took {} seconds on node {} of rack", "All rights reserved .", "one two three four {} six seven eight"]
    words = ["alpha", "beta", "gamma", "7", "x9", "delta"]
    rows = []
    for i in range(60):
        lines = [rng.choice(frames).format(*(rng.choice(words) for _ in range(3))) for _ in range(rng.randint(0, 4))]
        lines += [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 4))]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    got = run(docs(rows))
    assert got == plain(rows) and got != sorted(rows, key=str)


def test_variable_fields_make_one_template(docs):
    rows = [(i, f"Visitor number {i} came from {w} this very morning\n{w}{w} stands in one document only") for i, w in enumerate("abcdef")]
    got = dict(run(docs(rows)))
    assert got[0] == rows[0][1]
    assert all(got[i] == rows[i][1].split("\n")[1] for i in range(1, 6))


def test_inner_and_rare_lines_stay(docs):
    rows = [(20, "again and again here\n" * 9), *[(30 + i, "only four documents have it") for i in range(4)]]
    assert run(docs(rows)) == sorted(rows, key=str)


def test_short_lines_recur_as_they_are(docs):
    rows = [(i, f"Read more\nhome\n\nown {'abcdefghi'[i] * 3}") for i in range(9)]
    got = dict(run(docs(rows)))
    assert got[0] == rows[0][1] and all(got[i] == f"\nown {'abcdefghi'[i] * 3}" for i in range(1, 9))


def test_long_lines_recur_from_two_documents_on(docs):
    long = "a passage of quite some words that two documents share"
    rows = [(1, long), (2, f"x\n{long}"), (3, "short line of two"), (4, "short line of two")]
    assert dict(run(docs(rows))) == {1: long, 2: "x", 3: "short line of two", 4: "short line of two"}


@pytest.mark.parametrize("noise", [0, 40])
def test_several_templates_of_a_leaf(docs, noise):
    """Three templates with names in the same leaf, one line with very many copies, and lines that
    are like none."""
    rng = random.Random(3)
    name = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(9))
    width, frames = 9, ["the user said hello to {} in big halls", "the user said goodbye as {} left small rooms", "the user said nothing of {} over long weeks"]
    rows = [(i, "\n".join(f.format(name()) for f in frames)) for i in range(30)]
    rows += [(100 + i, "the user said one hot line again and again") for i in range(200)]
    rows += [(400 + i, "the user said " + " ".join(name() for _ in range(width - 3))) for i in range(noise)]
    got = dict(run(docs(rows)))
    assert all(got[i] == "" for i in range(1, 30)) and got[0] == rows[0][1]
    assert got[100] == "the user said one hot line again and again" and all(got[100 + i] == "" for i in range(1, 200))
    assert all(got[400 + i] == rows[230 + i][1] for i in range(noise))
    assert sorted(got.items(), key=str) == plain(rows)


def test_nulls_repeats_empties_and_clashes(docs):
    line = "the same line everywhere\t again "
    rows = [(None, line), (None, line), (1, line), (1, line + "\nmore of it"), (2, None), (3, ""), *[(i, line) for i in range(10, 15)], (16, "\n" * 5000 + line)]
    df = docs(rows).withColumn("n_lines", F.lit("clash")).withColumn("pos", F.lit(1)).withColumn("line", F.lit("x"))
    out = ld.dedup(df)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == plain(rows)
    assert set(out.columns) == set(df.columns) | {"n_dropped"}
    assert {(r.doc_id, r.n_lines, r.n_dropped) for r in out.where("doc_id IN (1, 2, 3, 16)").collect()} == {(1, 1, 0), (1, 2, 0), (2, 0, 0), (3, 1, 0), (16, 5001, 1)}
    assert run(docs([])) == []


def test_all_documents_but_null_ids(docs):
    rows = [(None, "a line of null ids")] * 6
    assert run(docs(rows)) == rows  # one document

"""Language profiles: held-out accuracy, and n-grams against plain counting."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid
from millrace.llm.queries import QUERIES


def plain(text):
    padded = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ").split()
    out = Counter()
    for word in padded:
        out.update(word)
        line = f" {word} "
        out.update(line[i:i + 2] for i in range(len(line) - 1))
        out.update(line[i:i + 3] for i in range(len(line) - 2))
    return out


def code(gram):
    out = 0
    for c in gram:
        out = out << 21 | (langid.EDGE if c == " " else ord(c))
    return out


@pytest.mark.parametrize("text", ["A cat, a dog; a CAT!", "Éçole für alle", "x", "1 2 3", "don't", "a\nb\tc " * 50])
def test_grams_are_those_of_plain_counting(text):
    want = Counter({code(g): n for g, n in plain(text).items()})
    assert dict(zip(*(x.tolist() for x in langid.grams(text)))) == dict(want)


def test_ranks_break_ties_by_code():
    gram = langid.ranked("b a", 3)
    assert gram.tolist() == sorted(gram.tolist())


def test_undetermined_and_empty(docs):
    out = docs([(1, None), (2, ""), (3, "12 !? \n"), (4, "word"), (None, "word"), (4, "word")])
    nothing = langid.predictor({})
    assert {tuple(r.x) for r in out.select(nothing("text").alias("x")).collect()} == {("und", 0.0)}
    known = langid.predictor({"aa": langid.ranked("word word").tolist(), "bb": langid.ranked("autre chose").tolist()})
    got = [tuple(r.x) for r in out.select(known("text").alias("x")).collect()]
    assert got[:3] == [("und", 0.0)] * 3 and [g[0] for g in got[3:]] == ["aa"] * 3
    assert all(0 <= g[1] <= 1 for g in got)
    assert langid.profiles(out.limit(0).withColumn("lang", F.lit("aa")), "text", "lang") == {}


def test_equal_distances_go_to_the_first_language(docs):
    same = langid.ranked("word").tolist()
    predict = langid.predictor({"zz": same, "aa": same})
    assert docs([(1, "word")]).select(predict("text")["lang"].alias("x")).first().x == "aa"


def test_held_out_accuracy(spark, sf_dir, documents):
    truth = {r.doc_id: r.lang for r in documents.collect()}
    rows = QUERIES["op8_language"](spark, sf_dir).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    hits = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out and truth[r.doc_id]]
    assert len(hits) > 20 and np.mean(hits) > 0.97


def test_held_out_and_unlabelled_rows_teach_nothing(docs, spark):
    kept = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 4 == 2)
    rows = [(kept, "zebra zebra", "zz"), (kept + 1, "word", None), (kept + 2, "alpha", "aa"), (None, "nul", "nn")]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string").where(~langid.held_out("doc_id"))
    assert set(langid.profiles(labelled, "text", "lang")) <= {"aa", "nn"}


def rank_list(text, ranks):
    return [g for g, _ in sorted(((code(g), n) for g, n in plain(text).items()), key=lambda x: (-x[1], x[0]))][:ranks]


def test_profiles_and_distances_against_plain_counting(spark, documents, monkeypatch):
    """Lists, out-of-place distances and scores, with tasks that hold few n-grams at a time."""
    monkeypatch.setattr(langid, "HELD", 500)
    rows = [(r.doc_id, r.text, r.lang) for r in documents.where("n_chars < 2000").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    total = {}
    for i, t, lang in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2 and lang and t:
            total.setdefault(lang, Counter()).update(Counter({code(g): n for g, n in plain(t).items()}))
    lists = {of: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))][:langid.RANKS] for of, c in total.items()}
    assert langid.profiles(docs.where(~langid.held_out("doc_id")), "text", "lang") == lists
    got = {r.doc_id: r.x for r in docs.select("doc_id", langid.learned(docs)("text").alias("x")).collect()}
    for i, t, _ in rows:
        own = rank_list(t or "", langid.RANKS)
        if not own:
            assert tuple(got[i]) == ("und", 0.0)
            continue
        far = {of: sum(abs(known.index(g) - k) if g in known else langid.RANKS for k, g in enumerate(own)) for of, known in lists.items()}
        best = min(sorted(far), key=far.get)
        assert got[i].lang == best and abs(got[i].score - (1 - far[best] / (langid.RANKS * len(own)))) < 1e-12

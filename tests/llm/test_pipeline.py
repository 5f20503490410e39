"""The pipeline's stages, one after the other, against what each has to do."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import bpe, simhash
from millrace.llm.queries import RANKS
from tests.llm.test_linededup import plain as plain_lines
from tests.llm.test_simhash import brute
from tests.llm.test_simhash import plain as plain_print


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, sf_dir).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = before.collect(), after.collect()
        if k < 4:
            assert set(after.columns) == set(docs.columns)
        before = after
    assert list(kept) == ["language", "lines", "near duplicates", "benchmark", "tokens"]
    told, left = kept["language"]
    assert {r.doc_id for r in left} == {r.doc_id for r in told if any(c.isalpha() for c in r.text or "")}
    told, left = kept["lines"]
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == plain_lines([(r.doc_id, r.text) for r in told])
    assert all(r.n_chars == len(r.text) for r in left)
    told, left = kept["near duplicates"]
    tops = brute(sorted((r.doc_id, plain_print(r.text)) for r in told))
    assert sorted(r.doc_id for r in left) == sorted(set(tops.values()))
    text = {r.doc_id: r.text for r in told}
    assert all(r.text == text[r.doc_id] for r in left)
    told, left = kept["benchmark"]
    bench = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert {r.doc_id for r in left} == {r.doc_id for r in told if not any(t in r.text for t in bench)}
    told, left = kept["tokens"]
    twin = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    text = {r.doc_id: r.text for r in told}
    assert len(left) == len(told)
    for r in left:
        assert np.frombuffer(r.ids, "<u4").tolist() == twin.encode_ordinary(text[r.doc_id])
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_first_of_groups_keeps_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("first", F.lit(1))
    assert simhash.first_of_groups(docs).columns == docs.columns

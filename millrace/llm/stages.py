"""Stages of the corpus pipeline.  Each takes (spark, docs, sf_dir), works on all of ``docs`` and
returns the columns of documents, the last one the tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, langid, linededup, simhash
from millrace.llm.queries import RANKS


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter (null or empty texts, say) go.  ``lang``
    becomes the language found.  Rows that repeat are judged alike and all stay."""
    predict = langid.learned(docs)
    return (
        docs.withColumn("__lang", predict("text")["lang"]).where(F.col("__lang") != langid.UNDETERMINED)
        .withColumn("lang", F.col("__lang")).select(*docs.columns)
    )


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates, which the one with the smallest doc_id
    keeps; ``n_chars`` follows the text.  Null texts stay null, repeated rows stay as many."""
    return linededup.dedup(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of the SimHash operator (three words, three bits), the one with the
    smallest doc_id.  Null and empty texts are one group; of repeated rows one stays."""
    return simhash.first_of_groups(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.  Null texts hold none."""
    found = decontaminate.find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.clean(docs, found)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids as little-endian unsigned 32-bit integers, and the digest of the
    bytes that they decode to; a row for each row, null texts as empty ones."""
    both = docs.select("doc_id", bpe.round_trip(spark, RANKS, public_tokenizers.PATTERN)("text").alias("x"))
    return both.select("doc_id", bpe.count(F.col("x.ids")).alias("n_tokens"), "x.ids", F.sha2("x.decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("tokens", tokens),
]

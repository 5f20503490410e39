"""Corpus pipeline: documents in, token ids out, in stages that each work on all that the
stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import stages
from millrace.scratch import keep

STAGES = stages.STAGES
#: Language profiles, projections and merges are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs

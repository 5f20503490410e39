from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs."""
    def make(rows, schema=DOCS):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

"""From wrangled rows to a feature table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame

from millrace.functions.parsing import to_time, to_type, zero_for_null
from millrace.ml import features, models
from millrace.ml.labels import LabelNumbers
from millrace.ml.values import EachValue
from millrace.operators import ddl
from millrace.operators.aggregates import dedupe
from millrace.sources import sinks


def wrangle(
    rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...],
    floats: Mapping[str, str], time_text: str, time: str, pattern: str,
    required: tuple[str, ...],
) -> DataFrame:
    """Rows with the required columns, one per key, typed, without null numbers.

    ``floats`` maps new float columns to the text columns they are parsed from.
    """
    typed = dedupe(rows.na.drop(subset=list(required)), keys, order).withColumns(
        {
            **{new: to_type(text, "float") for new, text in floats.items()},
            time: to_time(time_text, pattern),
        }
    )
    return zero_for_null(typed.drop(*[t for n, t in floats.items() if t != n]))


def feature_pipeline(
    description: str = "description", country: str = "country_code", quantity: str = "quantity",
    price: str = "unit_price", time: str = "invoice_time", price_threshold: float = 10.0, parts: int = 1,
) -> Pipeline:
    """All stages from text, category, price and month columns to ``features``,
    ``scaled_features`` and ``selected_features``, as one estimator."""
    words = [features.tokenizer(description, "desc_terms"), features.stop_words_remover("desc_terms", "desc_nostops")]
    return Pipeline(stages=[
        SQLTransformer(statement=f"SELECT *, month(`{time}`) AS invoice_month FROM __THIS__"),
        features.binarizer(price, "binarized_price", price_threshold),
        EachValue(columns=[description], stages=words),
        EachValue(columns=["desc_nostops"], stages=[features.word_learner("desc_nostops", "desc_vec", parts=parts)]),
        LabelNumbers(inputs=[country, quantity, "invoice_month"], outputs=["country_indexed", "quantity_indexed", "month_indexed"]),
        features.one_hot("country_indexed", "country_ohe"),
        features.assembler(["desc_vec", "country_ohe", "binarized_price", "month_indexed", "quantity_indexed"], "features"),
        features.scaler("features", "scaled_features"),
        features.slicer("scaled_features", "selected_features", [1]),
    ])


def fit_features(rows: DataFrame, **columns) -> PipelineModel:
    """The fitted job; it can be saved, loaded elsewhere and applied to new rows, of which those with
    a label that it has not seen drop out.

    Three stages look at the data, each at a few columns: the words, the labels of all
    categories at once, the deviations.  ``rows`` should be stored, as each is a pass over them.
    """
    return feature_pipeline(**columns, parts=features.word_parts(rows)).fit(rows)


def build_features(rows: DataFrame, **columns) -> DataFrame:
    """``rows`` with their features.  They are written once, so that each pass reads columns from
    disk and not the joins that made them."""
    base = models.prepared(rows)
    return fit_features(base, **columns).transform(base)


def save_features(frame: DataFrame, database: str, name: str, location: str) -> DataFrame:
    """Feature table under a database name, stored at a path; later jobs read it by name."""
    spark = frame.sparkSession
    ddl.create_database(spark, database)
    sinks.save_table(frame, f"{database}.{name}", path=location, mode="overwrite")
    return spark.table(f"{database}.{name}")

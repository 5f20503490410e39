"""Integrate, cleanse and type retail rows: the batch flagship."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.parsing import to_type
from millrace.operators.aggregates import dedupe
from millrace.operators.columns import rename_and_drop
from millrace.operators.joins import join_on, positional_join
from millrace.operators.sets import union_by_position

KEYS = ("InvoiceNo", "InvoiceDate", "StockCode")


def country_codes(raw: DataFrame) -> DataFrame:
    """The columns of the country list that jobs use."""
    return rename_and_drop(
        raw,
        {
            "OFFICIAL LANG CODE": "CountryCode", "ISO2 CODE": "ISO2Code",
            "ISO3 CODE": "ISO3Code", "LABEL EN": "CountryName", "Geo Shape": "GeoShape",
        },
        ("ONU CODE", "IS ILOMEMBER", "IS RECEIVING QUEST", "LABEL FR", "LABEL SP",
         "geo_point_2d"),
    )


def integrate(
    retail: Sequence[DataFrame], countries: DataFrame, income: DataFrame | None = None,
    retail_order: Sequence[str] = KEYS, income_order: Sequence[str] = (),
) -> DataFrame:
    """All retail files, each row with its country and, by position, a person's income row."""
    rows = union_by_position(*retail)
    if income is not None:
        # Before the country join: that one may repeat rows, positions may not.
        rows = positional_join(rows, income, retail_order, income_order, "RetailIDx", spread_ties=True)
    return join_on(rows, countries, [("Country", "CountryName")], "left_outer")


def cleanse(
    integrated: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = (),
    types: dict[str, str] | None = None, names: dict[str, str] | None = None,
) -> DataFrame:
    """Drop helper columns, keep one row per key, cast and rename."""
    slim = integrated.drop("Country", "ISO2Code", "ISO3Code", "RetailIDx", "idx", "IncomeIDx")
    single = dedupe(slim, keys, order)
    typed = single.withColumns({c: to_type(c, t) for c, t in (types or {}).items()})
    return typed.withColumnsRenamed(names or {})


def country_report(clean: DataFrame) -> DataFrame:
    """Lines, lines with a person, quantity and revenue per country."""
    return clean.groupBy("country_name").agg(
        F.count("*").alias("n_lines"),
        F.count("work_class").alias("n_people"),
        F.sum("quantity").alias("quantity"),
        F.round(F.sum(F.col("unit_price") * F.col("quantity")), 2).alias("revenue"),
    )

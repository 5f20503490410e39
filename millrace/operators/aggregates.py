"""Grouping operators.  All of them combine inside each task before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def word_counts(words: DataFrame, word: str = "word", name: str = "n") -> DataFrame:
    """Rows per word; null is a word of its own here (see ``word_counts_sql``)."""
    return words.groupBy(word).agg(F.count("*").alias(name))


def word_counts_functional(lines: DataFrame, name: str = "n") -> DataFrame:
    """Word count written with functions over an RDD of lines.

    Kept for users of the functional form; ``reduceByKey`` combines per
    partition.  The DataFrame form stays in the JVM and is the faster one.
    """
    text = lines.columns[0]
    counts = (
        lines.select(text)
        .rdd.flatMap(lambda row: row[0].split(" "))
        .map(lambda word: (word, 1))
        .reduceByKey(lambda a, b: a + b)
    )
    schema = T.StructType(
        [T.StructField("word", T.StringType()), T.StructField(name, T.LongType())]
    )
    return lines.sparkSession.createDataFrame(counts, schema)


def dedupe(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), keep: str = "first"
) -> DataFrame:
    """One row per key; nulls in keys compare equal.

    With ``order`` the kept row is the first (or last) by those columns.  The
    filter on the first row number lets Catalyst put a WindowGroupLimit before
    the shuffle: each task sends one row per key, so a key with a third of all
    rows does not gather in one task.
    """
    if not order:
        return df.dropDuplicates(list(keys))
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    direction = F.asc if keep == "first" else F.desc
    window = Window.partitionBy(*keys).orderBy(*[direction(c) for c in order])
    return (
        df.withColumn("__row", F.row_number().over(window)).where("__row = 1").drop("__row")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).where(F.col(name) > 1)


def _long_form(one_row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*structs)))


def _statistic(column: str, stat: str, number: Column | None, text: Column | None) -> Column:
    nothing = F.lit(None)
    return F.struct(
        F.lit(column).alias("column_name"),
        F.lit(stat).alias("stat"),
        (nothing if number is None else number).cast("double").alias("number"),
        (nothing if text is None else text).cast("string").alias("text"),
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None, scale: int = 6) -> DataFrame:
    """count/mean/stddev/min/max per column as typed rows.

    Numeric statistics are in ``number``; min and max of text are in ``text``.
    Numbers and text are aggregated apart: no column is read twice, and the
    numbers keep their generated hash aggregate, which one text column would
    turn into an interpreted sort aggregate for all.
    """
    columns = list(columns or df.columns)
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    parts = []
    numbers = [c for c in columns if c in numeric]
    if numbers:
        aggs, rows = [], []
        for i, c in enumerate(numbers):
            aggs += [
                F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"),
                F.stddev_samp(c).alias(f"s{i}"), F.min(c).alias(f"lo{i}"),
                F.max(c).alias(f"hi{i}"),
            ]
            rows += [
                _statistic(c, "count", F.col(f"n{i}"), None),
                _statistic(c, "mean", F.round(f"m{i}", scale), None),
                _statistic(c, "stddev", F.round(f"s{i}", scale), None),
                _statistic(c, "min", F.col(f"lo{i}"), None),
                _statistic(c, "max", F.col(f"hi{i}"), None),
            ]
        parts.append(_long_form(df.agg(*aggs), rows))
    others = [c for c in columns if c not in numeric]
    if others:
        aggs, rows = [], []
        for i, c in enumerate(others):
            aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
            rows += [
                _statistic(c, "count", F.col(f"n{i}"), None),
                _statistic(c, "min", None, F.col(f"lo{i}")),
                _statistic(c, "max", None, F.col(f"hi{i}")),
            ]
        parts.append(_long_form(df.agg(*aggs), rows))
    return reduce(DataFrame.union, parts)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column_name, nulls) for all columns from one scan."""
    columns = list(columns or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    return _long_form(
        one,
        [
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls"))
            for i, c in enumerate(columns)
        ],
    )


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))

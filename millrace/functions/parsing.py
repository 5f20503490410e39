"""Scalar parsing: bad input gives null, the row stays.  ANSI mode stays on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_type(column: str, type_name: str) -> Column:
    """Cast; malformed text becomes null."""
    return F.col(column).try_cast(type_name)


def to_time(column: str, pattern: str = "dd/M/yy HH:mm") -> Column:
    """Timestamp by pattern; text that does not match becomes null."""
    return F.try_to_timestamp(F.col(column), F.lit(pattern))


def from_message(column: str, schema: T.StructType | str) -> Column:
    """JSON text to struct; a malformed message gives null fields."""
    return F.from_json(F.col(column), schema)


def to_message(
    df: DataFrame, key: str, columns: list[str] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Rows as (key string, value JSON text), the form a topic takes."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*(columns or df.columns))).alias("value"),
        *keep,
    )


def zero_for_null(df: DataFrame) -> DataFrame:
    """Null numbers become 0; text, dates and other types are left alone."""
    return df.na.fill(0)

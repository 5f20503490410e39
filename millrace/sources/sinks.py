"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_csv(
    df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", **options: str
) -> None:
    """CSV files that read back whole: binary columns become base64 text on one line,
    times keep their microseconds (the format's default cuts them to milliseconds)."""
    plain = [
        F.translate(F.base64(f.name), "\r\n", "").alias(f.name)
        if isinstance(f.dataType, T.BinaryType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    writer = df.select(*plain).write.mode(mode).option("header", header)
    writer.options(**{**EXACT_TIMES, **options}).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "error", **options: str) -> None:
    """JSON lines; times keep their microseconds."""
    df.write.mode(mode).options(**{**EXACT_TIMES, **options}).json(path)


def write_lines(df: DataFrame, path: str, sep: str = " ", mode: str = "error") -> None:
    """Text files: the columns of a row joined by ``sep`` (nulls are left out)."""
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns])
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "error", files: int | None = None
) -> None:
    """Parquet files.  ``files`` merges output partitions; leave it unset on large
    data, where adaptive execution already sizes them."""
    out = df.coalesce(files) if files else df
    out.write.mode(mode).parquet(path)


def write_first_rows(df: DataFrame, path: str, n: int, mode: str = "error") -> None:
    """Write ``n`` rows, the first ones of the frame's partitions in their order.

    One pass counts the rows per partition; each partition then knows how many of its own
    it has to write, and all write in parallel.  ``df`` should be a scan or a kept frame,
    whose partitions are the same both times.
    """
    place = df.withColumn("__place", F.monotonically_increasing_id())
    part = F.shiftright("__place", 33)
    counts = place.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    quota = counts.withColumn("__quota", F.lit(n) - F.coalesce(before, F.lit(0))).where("__quota > 0")
    own = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    some = place.withColumn("__part", part).join(quota, "__part").where(own < F.col("__quota"))
    some.select(*df.columns).write.mode(mode).parquet(path)


def save_default(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    """Save in the session's default format, whatever the path is called."""
    df.write.mode(mode).options(**options).save(path)


def save_table(
    df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None,
    mode: str = "error",
) -> None:
    """Managed table, or external table when ``path`` is given."""
    writer = df.write.mode(mode).format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def insert_into(df: DataFrame, name: str, overwrite: bool = False) -> None:
    """Append to a catalog table by position, or replace its content."""
    df.write.insertInto(name, overwrite=overwrite)


def partition_rows(df: DataFrame) -> DataFrame:
    """Rows per partition of the frame as it is now."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count("*").alias("n_rows")
    )

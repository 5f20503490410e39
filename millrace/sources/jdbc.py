"""External databases.  The options are Spark's own; nothing here opens a connection
before an action runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str, table: str, driver: str | None = None, user: str | None = None,
    password: str | None = None,
) -> dict[str, str]:
    given = {"url": url, "dbtable": table, "driver": driver, "user": user, "password": password}
    return {k: v for k, v in given.items() if v is not None}


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int | None = None,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """Database table.  With ``split_column``, ``bounds`` and ``parts`` many tasks read
    ranges of it; without, one task reads all of it."""
    reader = spark.read.format("jdbc").options(**options).option("fetchsize", fetch_rows)
    if split_column:
        if bounds is None or parts is None:
            raise ValueError("a split read needs bounds and parts")
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", parts)
        )
    return reader.load()


def jdbc_view_sql(name: str, options: dict[str, str]) -> str:
    """Statement that declares the database table as a temporary view."""
    opts = ", ".join("{} '{}'".format(k, v.replace("'", "\\'")) for k, v in options.items())
    return (
        f"CREATE OR REPLACE TEMPORARY VIEW {name} USING org.apache.spark.sql.jdbc "
        f"OPTIONS ({opts})"
    )


def write_jdbc(
    df: DataFrame, options: dict[str, str], mode: str = "append", parts: int = 16,
    batch_rows: int = 10_000,
) -> None:
    """Write with at most ``parts`` connections at a time."""
    (
        df.write.format("jdbc")
        .options(**options)
        .option("numPartitions", parts)
        .option("batchsize", batch_rows)
        .mode(mode)
        .save()
    )

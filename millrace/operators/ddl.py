"""Catalog statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def create_table(
    spark: SparkSession, name: str, columns: str = "", fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """Table by column list, or over the files at ``location``."""
    listed = f" ({columns})" if columns else ""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name}{listed} USING {fmt}{where}")


def drop_table(spark: SparkSession, name: str, if_exists: bool = True) -> None:
    spark.sql(f"DROP TABLE {'IF EXISTS ' if if_exists else ''}{name}")


def rename_table(spark: SparkSession, name: str, new_name: str) -> None:
    spark.sql(f"ALTER TABLE {name} RENAME TO {new_name}")


def add_columns(spark: SparkSession, name: str, columns: str) -> None:
    """New columns read as null in the rows that are there already."""
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def drop_database(spark: SparkSession, name: str, cascade: bool = False) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name}{' CASCADE' if cascade else ''}")


def tables_of(spark: SparkSession, database: str) -> DataFrame:
    """Use the database and list its tables."""
    spark.sql(f"USE {database}")
    return spark.sql("SHOW TABLES")

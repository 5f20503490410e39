"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    header: bool = True,
    schema: T.StructType | str | None = None,
    infer: bool = False,
    sampling: float = 1.0,
    sep: str = ",",
    **options: str,
) -> DataFrame:
    """CSV file or folder.

    Without a schema all columns are text (``_c0 ...`` without header).
    ``infer`` costs one more pass; ``sampling`` below 1 shortens it but may
    then miss a type, so jobs on large data should state the schema.
    """
    reader = spark.read.option("header", header).option("sep", sep).options(**options)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).option("samplingRatio", sampling).csv(path)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON lines; columns are inferred (one more pass) unless a schema is given."""
    return spark.read.schema(schema).json(path) if schema else spark.read.json(path)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Image folder: struct ``image`` with origin, height, width, nChannels, mode, data."""
    return spark.read.format("image").load(path)


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows per data file of a scan; ``df`` must be the frame a reader returned."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.count("*").alias("n_rows")
    )


def path_as_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``SELECT * FROM fmt.`path```."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def file_view(
    spark: SparkSession, name: str, path: str, fmt: str = "csv", columns: str = "",
    **options: str,
) -> DataFrame:
    """Temporary view declared in SQL over files."""
    listed = f" ({columns})" if columns else ""
    opts = ", ".join(f"`{k}` '{v}'" for k, v in {"path": path, **options}.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name}{listed} USING {fmt} OPTIONS ({opts})")
    return spark.table(name)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of a parquet table that is a folder or a single file."""
    batch = spark.read.parquet(path)
    reader = spark.readStream.schema(schema or batch.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    folder, _, leaf = path.rstrip("/").rpartition("/")
    first = batch.select("_metadata.file_name").first()
    if first is not None and first[0] == leaf:      # the path is the file itself
        return reader.option("pathGlobFilter", leaf).parquet(folder)
    return reader.parquet(path)


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    header: bool = True,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of CSV files that arrive in a folder; the schema is always given."""
    reader = spark.readStream.schema(schema).option("header", header)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path)

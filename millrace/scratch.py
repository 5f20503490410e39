"""Intermediate tables in the folder that all executors share.

The cluster names that folder in ``spark.checkpoint.dir``.  Only in local mode, where
the driver is the one executor, a folder is made if the setting is absent.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Folders made in local mode, by application.
_OWN: dict[str, str] = {}


class NoSharedFolder(RuntimeError):
    """A cluster without a folder that all executors share."""


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(SETTING, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise NoSharedFolder(f"set {SETTING} to a folder that the driver and all executors share")
        # the setting cannot be changed in a running session, so the folder is kept here
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = tempfile.mkdtemp(prefix="millrace-")
        root = _OWN[app]
    return root.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody used before, below the shared folder."""
    return f"{shared_root(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str = "keep") -> DataFrame:
    """Write ``df`` once and read it back: ends the lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_pieces(df: DataFrame, rows: int, label: str = "pieces") -> DataFrame:
    """Like ``keep``, and every task that reads it back gets at most ``rows`` rows, however little
    room they take on disk: what a learner makes of a row is often many times larger.

    A file is a piece.  Files go to tasks by the settings of the session that reads, so a session of
    its own, with the same settings but this one, reads them; the frames of both can be joined.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.mode("error").option("maxRecordsPerFile", rows).parquet(path)
    reader = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if reader.conf.isModifiable(k):
            reader.conf.set(k, v)
    # a file counts as a whole split besides its own bytes, so no other one fits beside it
    whole = spark.conf.get("spark.sql.files.maxPartitionBytes")
    reader.conf.set("spark.sql.files.openCostInBytes", whole)
    return reader.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer partitions than the cluster has cores (say one file with one
    row group) dealt out to all of them; any larger scan as it is."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def work_database(spark: SparkSession) -> str:
    """Database whose managed tables live in the shared folder."""
    name = "mr_" + re.sub(r"\W", "_", spark.sparkContext.applicationId)
    location = f"{shared_root(spark)}/millrace/{name}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


def new_name(label: str) -> str:
    """Catalog name (table or view) nobody used before."""
    return f"{label}_{uuid.uuid4().hex[:12]}"

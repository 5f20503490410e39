"""Tables whose rows lie in folders by the hash of their key, so that a change touches few of them.

Update, delete and merge write the changed folders anew and leave all others as they are: the new
content is stored first and then put in place by Spark's dynamic partition overwrite.  There is no log
and no older version; a change that was cut off is run again with the same result.  One writer at a
time.

How many folders there are is decided once, by bytes, and is part of the folder column's name, so
every reader and writer deals keys out alike.  Null keys have a folder of their own and match nothing.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.joins import plan_bytes
from millrace.scratch import keep

FOLDER_BYTES = 64 << 20
#: So many folder numbers are shipped to every task at most.
MOST_FOLDERS = 1 << 20
_NO_ROWS = -2
_NAME = re.compile(r"__folder_of_([0-9]+)")


class RepeatedKeys(ValueError):
    """A merge source holds one key twice."""


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), tuple(keys)

    def create(self, df: DataFrame, folders: int | None = None) -> None:
        """Write all rows.  Without ``folders`` there is one for each ``FOLDER_BYTES``."""
        n = min(MOST_FOLDERS, folders or -(-plan_bytes(df) // FOLDER_BYTES))
        name = f"__folder_of_{n}"
        self._write(df.withColumn(name, self._folder(n)), name, "error")
        # a file without rows, which no change touches, says what the columns are
        df.limit(0).coalesce(1).write.parquet(f"{self.path}/{name}={_NO_ROWS}")

    def read(self) -> DataFrame:
        rows, name = self._open()
        return rows.drop(name)

    def files(self) -> DataFrame:
        """(folder, file): what the table consists of now."""
        rows, name = self._open()
        return rows.select(F.col(name).alias("folder"), F.col("_metadata.file_path").alias("file")).distinct()

    def merge(self, rows: DataFrame) -> int:
        """Replace the rows that have a key of ``rows``, add those whose key is new; the number of
        folders written.  A key that occurs twice in ``rows`` is refused."""
        table, name = self._open()
        fresh = keep(rows.select(*[c for c in table.columns if c != name]).withColumn(name, self._folder(_count(name))), "merge-source")
        known = fresh.na.drop(subset=list(self.keys))
        if known.groupBy(*self.keys).agg(F.count("*").alias("n")).where("n > 1").first() is not None:
            raise RepeatedKeys(f"source holds a key twice: {', '.join(self.keys)}")
        stay = self._of(table, fresh.select(name).distinct(), name).join(known.select(*self.keys), list(self.keys), "left_anti")
        return self._replace(stay.select(*fresh.columns).unionByName(fresh), fresh.select(name).distinct(), name)

    def update(self, condition: str, values: Mapping[str, Column | object], keys: DataFrame | None = None) -> int:
        """Set columns where the condition is true.  With ``keys`` (rows of the key columns) only
        their folders are looked at, and only rows with these keys change.  Key columns stay."""
        if set(values) & set(self.keys):
            raise ValueError("a key cannot change; delete the row and add it anew")
        types = {f.name: f.dataType for f in self._open()[0].schema.fields}

        def change(df: DataFrame, where: Column) -> DataFrame:
            return df.withColumns({n: F.when(where, (v if isinstance(v, Column) else F.lit(v)).cast(types[n])).otherwise(F.col(n))
                                   for n, v in values.items()})

        return self._change(condition, keys, change)

    def delete(self, condition: str = "true", keys: DataFrame | None = None) -> int:
        """Remove the rows for which the condition is true; null keeps a row.  ``keys`` as in ``update``."""
        return self._change(condition, keys, lambda df, where: df.where(~where))

    # -- inside -----------------------------------------------------------

    def _folder(self, n: int) -> Column:
        some = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in self.keys))
        return F.when(some, F.pmod(F.xxhash64(*self.keys), F.lit(n))).otherwise(F.lit(-1)).cast("int")

    def _open(self) -> tuple[DataFrame, str]:
        table = self.spark.read.parquet(self.path)
        return table, next(c for c in table.columns if _NAME.fullmatch(c))

    def _of(self, table: DataFrame, folders: DataFrame, name: str) -> DataFrame:
        """The rows of some folders; the others' files are not opened."""
        return table.join(F.broadcast(folders), name, "left_semi")

    def _change(self, condition: str, keys: DataFrame | None, change) -> int:
        table, name = self._open()
        where = F.coalesce(F.expr(condition), F.lit(False))
        if keys is not None:
            known = keep(keys.select(*self.keys).na.drop().distinct(), "changed-keys")
            table = self._of(table, known.select(self._folder(_count(name)).alias(name)).distinct(), name)
            table = table.join(known.withColumn("__changed", F.lit(True)), list(self.keys), "left").select(*table.columns, "__changed")
            where = where & F.coalesce(F.col("__changed"), F.lit(False))
        touched = keep(table.where(where).select(name).distinct(), "changed-folders")
        return self._replace(change(self._of(table, touched, name), where).drop("__changed"), touched, name)

    def _replace(self, rows: DataFrame, touched: DataFrame, name: str) -> int:
        """Put the new content of the touched folders in place; those left without rows go."""
        fresh = keep(rows, "folders")
        emptied = [r[0] for r in touched.join(fresh.select(name).distinct(), name, "left_anti").toLocalIterator()]
        self._write(fresh, name, "overwrite")
        if emptied:
            self._clear(name, emptied)
        return touched.count()

    def _clear(self, name: str, folders: list[int]) -> None:
        """Remove the files of folders without rows."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        root = hadoop(self.path)
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for f in folders:
            system.delete(hadoop(root, f"{name}={f}"), True)

    def _write(self, df: DataFrame, name: str, mode: str) -> None:
        # one task per folder, so that a folder is one file
        df.repartition(name).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(self.path)


def _count(name: str) -> int:
    return int(_NAME.fullmatch(name).group(1))

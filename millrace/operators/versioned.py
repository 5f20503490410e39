"""Tables with history on plain parquet: update, delete, merge, time travel, rollback.

A version is a list of immutable folders ("segments") plus the schema to read
them with.  A change writes new segments first and publishes the version last,
as one row in ``history/version=N``; until then readers cannot see it.

What a change costs:

* append     one new segment, nothing is rewritten
* schema     no rewrite; older segments read the new column as null
* rollback   no data at all; the new version lists the old segments
* update, delete, merge   rewrite only the segments that hold matching rows

With ``keys``, a commit is laid out in folders by the hash of the keys and each folder is a
segment, so a change of few keys rewrites few folders and no others.

One writer at a time: a second writer that publishes the same version number
fails, because the folder already exists, and leaves the table as it was.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.scratch import keep

_HISTORY = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("operation", T.StringType()),
    T.StructField("committed_ms", T.LongType()),
    T.StructField("segments", T.ArrayType(T.StringType())),
    T.StructField("schema_json", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])


_FOLDER = "__folder"
FOLDERS = 16


class SchemaMismatch(ValueError):
    """The rows to write do not have the table's columns and types."""


class DuplicateSourceKeys(ValueError):
    """A merge source holds one key twice."""


@dataclass(frozen=True)
class Version:
    number: int
    segments: tuple[str, ...]
    schema: T.StructType


def _types(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in schema.fields}


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


class VersionedTable:
    """``keys`` and ``folders`` say how this writer lays out its commits; readers need neither."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), folders: int = FOLDERS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys, self.folders = tuple(keys), folders

    # -- reading ----------------------------------------------------------

    def history(self) -> DataFrame:
        """Published versions, one row each."""
        return self.spark.read.schema(_HISTORY).json(f"{self.path}/history")

    def _version(self, number: int | None = None) -> Version:
        rows = self.history()
        if number is not None:
            rows = rows.where(F.col("version") == number)
        row = rows.orderBy(F.desc("version")).first()
        if row is None:
            raise ValueError(f"no version {number} of {self.path}")
        schema = T.StructType.fromJson(json.loads(row["schema_json"]))
        return Version(row["version"], tuple(row["segments"]), schema)

    def _scan(self, segments: Sequence[str], schema: T.StructType) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(
            *[f"{self.path}/segments/{s}" for s in segments]
        )

    def read(self, version: int | None = None) -> DataFrame:
        """Current rows, or the rows as of a version."""
        v = self._version(version)
        return self._scan(v.segments, v.schema)

    def current_version(self) -> int:
        return self._version().number

    # -- committing -------------------------------------------------------

    def _store(self, df: DataFrame) -> list[str]:
        """New segments with the rows, at most ``folders`` of them."""
        commit = uuid.uuid4().hex
        path = f"{self.path}/segments/{commit}"
        if not self.keys:
            df.write.mode("error").parquet(path)
            return [commit]
        folder = F.pmod(F.xxhash64(*self.keys), F.lit(self.folders)).cast("int")
        df.withColumn(_FOLDER, folder).write.mode("error").partitionBy(_FOLDER).parquet(path)
        whole = T.StructType([*df.schema.fields, T.StructField(_FOLDER, T.IntegerType())])
        used = self.spark.read.schema(whole).parquet(path).select(_FOLDER).distinct().collect()
        return sorted(f"{commit}/{_FOLDER}={r[0]}" for r in used)

    def _publish(
        self, number: int, operation: str, segments: Sequence[str], schema: T.StructType,
        source: str | None = None, batch_id: int | None = None,
    ) -> int:
        now = int(time.time() * 1000)
        row = (operation, now, list(segments), schema.json(), source, batch_id)
        fields = T.StructType([f for f in _HISTORY.fields if f.name != "version"])
        (
            self.spark.createDataFrame([row], fields)
            .coalesce(1)
            .write.mode("error")
            .json(f"{self.path}/history/version={number}")
        )
        return number

    def create(self, df: DataFrame) -> int:
        """First version."""
        return self._publish(0, "create", self._store(df), _nullable(df.schema))

    def _checked(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        have, want = _types(df.schema), _types(schema)
        if have != want:
            wrong = sorted(
                n for n in have.keys() | want.keys() if have.get(n) != want.get(n)
            )
            raise SchemaMismatch(f"columns differ from the table: {', '.join(wrong)}")
        return df.select(*schema.names)

    def append(
        self, df: DataFrame, merge_schema: bool = False,
        source: str | None = None, batch_id: int | None = None,
    ) -> int:
        """Add rows.  Other columns or types are refused; with ``merge_schema`` new
        columns join the table and old rows hold null there."""
        v = self._version()
        schema = v.schema
        if merge_schema:
            known = _types(schema)
            extra = [f for f in _nullable(df.schema).fields if f.name not in known]
            schema = T.StructType(schema.fields + extra)
            missing = [f for f in schema.fields if f.name not in df.columns]
            df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
        df = self._checked(df, schema)
        if source is not None and self.has_batch(source, batch_id):
            return v.number
        return self._publish(
            v.number + 1, "append", [*v.segments, *self._store(df)], schema, source, batch_id
        )

    def overwrite(self, df: DataFrame) -> int:
        """Replace all rows (and the schema); earlier versions stay readable."""
        v = self._version()
        return self._publish(v.number + 1, "overwrite", self._store(df), _nullable(df.schema))

    def rollback(self, version: int) -> int:
        """New version with the rows of an older one."""
        now, old = self._version(), self._version(version)
        return self._publish(now.number + 1, "rollback", old.segments, old.schema)

    def has_batch(self, source: str, batch_id: int | None) -> bool:
        """True if this stream batch is part of the table already."""
        seen = (F.col("source") == source) & (F.col("batch_id") == batch_id)
        return self.history().where(seen).first() is not None

    # -- changing rows ----------------------------------------------------

    def _segments_of(self, rows: DataFrame) -> list[str]:
        """Names of the segments in which ``rows`` lie; at most as many as there are segments."""
        names = rows.select("__segment").distinct()
        return [r[0] for r in names.toLocalIterator()]

    def _tagged(self, v: Version) -> DataFrame:
        place = F.regexp_extract(F.col("_metadata.file_path"), rf"/segments/([^/]+(?:/{_FOLDER}=[0-9]+)?)/", 1)
        return self._scan(v.segments, v.schema).withColumn("__segment", place)

    def _rewrite(
        self, operation: str, condition: Column, change: Callable[[DataFrame], DataFrame]
    ) -> int:
        v = self._version()
        if not v.segments:
            return self._publish(v.number + 1, operation, [], v.schema)
        touched = self._segments_of(self._tagged(v).where(condition))
        left = [s for s in v.segments if s not in touched]
        fresh = []
        if touched:
            fresh = self._store(change(self._scan(touched, v.schema)))
        return self._publish(v.number + 1, operation, [*left, *fresh], v.schema)

    def update(self, condition: str, values: dict[str, Column | object]) -> int:
        """Set columns where the condition is true; a null condition changes nothing."""
        where = F.expr(condition)

        def change(df: DataFrame) -> DataFrame:
            types = _types(df.schema)
            return df.withColumns({
                name: F.when(
                    where, (v if isinstance(v, Column) else F.lit(v)).cast(types[name])
                ).otherwise(F.col(name))
                for name, v in values.items()
            })

        return self._rewrite("update", where, change)

    def delete(self, condition: str) -> int:
        """Remove the rows for which the condition is true; null keeps the row."""
        where = F.expr(condition)
        return self._rewrite(
            "delete", where, lambda df: df.where(~F.coalesce(where, F.lit(False)))
        )

    def merge(
        self, rows: DataFrame, keys: Sequence[str],
        source: str | None = None, batch_id: int | None = None,
    ) -> int:
        """Upsert whole rows by key: matched rows are replaced, others inserted.

        Null keys match nothing.  A source key that occurs twice is refused.
        """
        v = self._version()
        if source is not None and self.has_batch(source, batch_id):
            return v.number
        fresh = keep(self._checked(rows, v.schema), "merge-source")
        not_null = fresh.na.drop(subset=list(keys))
        twice = not_null.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
        if twice.first() is not None:
            raise DuplicateSourceKeys(f"source holds a key twice: {', '.join(keys)}")
        wanted = not_null.select(*keys)
        touched: list[str] = []
        if v.segments:
            touched = self._segments_of(
                self._tagged(v).select(*keys, "__segment").join(wanted, list(keys), "left_semi")
            )
        left = [s for s in v.segments if s not in touched]
        if touched:
            stay = self._scan(touched, v.schema).join(wanted, list(keys), "left_anti")
            fresh = stay.select(*v.schema.names).unionByName(fresh)
        return self._publish(
            v.number + 1, "merge", [*left, *self._store(fresh)], v.schema, source, batch_id
        )

"""Joins whose plans hold when one side is large or one key is hot."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only after its bytes were summed against this bound.
BROADCAST_BYTES = 64 << 20
#: Statistics may be too large, for instance behind a filter, by this factor.
FAR = 64


def plan_bytes(df: DataFrame) -> int:
    """What the optimizer expects ``df`` to weigh; for scans the bytes of the files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bytes_up_to(df: DataFrame, most: int) -> int:
    """Bytes of all rows in Arrow's layout: a measure of what a broadcast would send.  A task stops to
    count once it alone has seen more than ``most``."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            seen += batch.nbytes
            if seen > most:
                break
        yield pa.record_batch({"n": pa.array([seen], pa.int64())})

    return df.mapInArrow(measure, "n long").agg(F.sum("n")).first()[0] or 0


def join_on(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "inner"
) -> DataFrame:
    """Equi-join on differently named keys; null keys never match.

    No hint: Catalyst broadcasts a side that its statistics prove small, and
    otherwise AQE splits skewed partitions of the shuffled join.
    """
    cond = reduce(lambda a, b: a & b, (left[lk] == right[rk] for lk, rk in pairs))
    return left.join(right, cond, how)


def broadcast_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join, of any kind, that ships ``right`` to every task if its bytes allow it; if not,
    the same join by a shuffle."""
    # a side that the statistics know to be far larger need not be measured
    small = plan_bytes(right) <= FAR * max_bytes and bytes_up_to(right, max_bytes) <= max_bytes
    return join_on(left, F.broadcast(right) if small else right, pairs, how)


def _key_texts(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """A row's keys as one string a side, equal if and only if the join finds the keys equal; null
    where a key is null."""
    sides: tuple[list[Column], list[Column]] = ([], [])
    for pair in pairs:
        both = left.select(pair[0]).limit(0).union(right.select(pair[1]).limit(0)).schema[0].dataType
        for side, name in zip(sides, pair):
            value = F.col(name).cast(both)
            # minus zero is zero
            side.append((value + F.lit(0).cast(both) if isinstance(both, T.FractionalType) else value).cast("string"))

    def text(parts: list[Column]) -> Column:
        some = reduce(lambda a, b: a & b, (p.isNotNull() for p in parts))
        return F.when(some, parts[0] if len(parts) == 1 else F.to_json(F.array(*parts)))

    return text(sides[0]), text(sides[1])


def hot_keys(df: DataFrame, key: Column, share: float) -> list:
    """The values of ``key`` that hold more than ``share`` of the rows, at most ``2 / share`` of
    them.  One pass with a sketch; where it errs, a key is called hot that nearly is."""
    most = int(2 / share)
    rows = df.select(key.alias("k")).where("k IS NOT NULL")
    found = rows.agg(F.expr(f"approx_top_k(k, {most}, {most * 20})").alias("top"), F.count("*").alias("n")).first()
    return [t["item"] for t in found["top"] or () if t["count"] > share * found["n"]]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str = "inner",
    salts: int = 32,
    hot_share: float = 0.01,
) -> DataFrame:
    """Inner or left join where single keys of either side may hold much of its rows.

    Keys above ``hot_share`` of the rows of a side are spread over ``salts`` reducers there,
    and only their partner rows are copied; every other key joins once, unsalted.  Without hot keys
    it is the plain join.  Rows of keys that are hot on the right have partners by definition, so a
    left join is an inner one for them.  The salt comes from a row's place, so both sides should
    be scans or kept frames, where a repeated task sees the same places.
    """
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("salting is exact for inner and left joins only")
    left_key, right_key = _key_texts(left, right, pairs)
    hot_left, hot_right = hot_keys(left, left_key, hot_share), hot_keys(right, right_key, hot_share)
    if not hot_left and not hot_right:
        return join_on(left, right, pairs, how)
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salts - 1))

    def dealt(df: DataFrame, key: Column, own: list, other: list, names: tuple[str, str]) -> DataFrame:
        """Own place where the key is hot here, all places of the other side where it is hot there."""
        df = df.withColumn(names[0], F.when(key.isin(own), place).otherwise(F.lit(0)))
        return df.withColumn(names[1], F.explode(F.when(key.isin(other), every).otherwise(F.array(F.lit(0)))))

    some_right = dealt(right, right_key, hot_right, hot_left, ("__rr", "__rl"))

    def joined(part: DataFrame, kind: str) -> DataFrame:
        part = dealt(part, left_key, hot_left, hot_right, ("__ll", "__lr"))
        cond = reduce(lambda a, b: a & b, (part[lk] == some_right[rk] for lk, rk in pairs))
        cond &= (part["__ll"] == some_right["__rl"]) & (part["__lr"] == some_right["__rr"])
        return part.join(some_right, cond, kind).drop("__ll", "__lr", "__rr", "__rl")

    if how == "inner" or not hot_right:
        return joined(left, how)
    busy = F.coalesce(left_key.isin(hot_right), F.lit(False))
    return joined(left.where(busy), "inner").unionByName(joined(left.where(~busy), "left"))


def positional_join(
    left: DataFrame,
    right: DataFrame,
    left_order: Sequence[str],
    right_order: Sequence[str],
    name: str = "idx",
    spread_ties: bool = False,
) -> DataFrame:
    """Left join of the n-th row of one frame with the n-th row of the other."""
    from millrace.operators.ordered import row_index

    numbered = row_index(left, left_order, name, spread_ties)
    partner = row_index(right, right_order, "__partner", spread_ties)
    # rows behind the partner's last one have none, so they stay where they are
    n = right.count()
    near = numbered.where(F.col(name) < n)
    met = near.join(partner, near[name] == partner["__partner"], "left_outer").drop("__partner")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return met.union(numbered.where(F.col(name) >= n).select("*", *none))

"""Positions, running totals and exact quantiles without one-task windows.

``row_number() over (partition by k order by x)`` sorts each ``k`` in a single
task, and the exact ``percentile`` aggregate keeps every distinct value of a
group in one buffer.  Neither survives a key that holds a third of all rows.
Here rows are range-partitioned over (keys, order), so a large key spans as
many partitions as it needs; what travels between partitions is one small
summary row per (partition, key).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.scratch import keep

_POS = "__pos"      # partition number in the high bits, row number in the low 33
_PART = "__part"
_TIE = "__tie"

_ROW_BITS = 33      # layout of monotonically_increasing_id

#: Values of a group that one window sorts to find a quantile.
WINDOW_ROWS = 50_000
#: Cells that a larger group is cut into.
CELLS = 64


def _placed(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], label: str,
    spread_ties: bool = False,
) -> DataFrame:
    """Rows sorted over the whole cluster and stored with their place.

    Stored, because a second evaluation may draw other range bounds and the
    summaries would then not match the rows.

    Rows that agree in all of ``keys`` and ``order`` fall into one range.  Where
    such copies may be many, ``spread_ties`` orders them by their place in the
    input.  That input must be stored, so that a repeated task sees the same places.
    """
    by = [F.col(c) for c in (*keys, *order)]
    columns = df.columns
    if spread_ties:
        df = df.withColumn(_TIE, F.monotonically_increasing_id())
        by.append(F.col(_TIE))
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by).select(*columns)
    stored = keep(ordered.withColumn(_POS, F.monotonically_increasing_id()), label)
    return stored.withColumn(_PART, F.shiftright(F.col(_POS), _ROW_BITS))


def _same_keys(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[n].eqNullSafe(right[n]) for n in names))


def row_index(
    df: DataFrame, order: Sequence[str], name: str = "idx", spread_ties: bool = False
) -> DataFrame:
    """Consecutive index 0, 1, 2, ... over the whole frame in ``order``.

    ``order`` should identify a row; with ``spread_ties`` the input is stored
    first and copies of a row may be many.  The summary has one row per
    partition, so broadcasting it is bounded by the partition count, whatever
    the data size.
    """
    if spread_ties:
        df = keep(df, "index-input")
    placed = _placed(df, [], order, "index", spread_ties)
    parts = placed.groupBy(_PART).agg(F.count("*").alias("__n"), F.min(_POS).alias("__first"))
    before = F.coalesce(
        F.sum("__n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    parts = parts.withColumn("__before", before).drop("__n")
    return (
        placed.join(F.broadcast(parts), _PART)
        .withColumn(name, F.col(_POS) - F.col("__first") + F.col("__before"))
        .select(*df.columns, name)
    )


def row_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position",
    spread_ties: bool = False,
) -> DataFrame:
    """Position 1, 2, 3, ... of every row inside its key; see ``row_index``."""
    if spread_ties:
        df = keep(df, "position-input")
    placed = _placed(df, keys, order, "position", spread_ties)
    parts = placed.groupBy(_PART, *keys).agg(
        F.count("*").alias("__n"), F.min(_POS).alias("__first")
    )
    earlier = (
        Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = keep(
        parts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n"),
        "position-parts",
    )
    return (
        placed.join(parts, _same_keys(placed, parts, [_PART, *keys]))
        .withColumn(name, (placed[_POS] - F.col("__first") + F.col("__before") + 1))
        .select(*[placed[c] for c in df.columns], name)
    )


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Sequence[float],
    accuracy: int = 20_000,
) -> DataFrame:
    """Rows (keys, q, value): linear-interpolated quantiles, exact at any group size.

    Two scans.  The first makes a mergeable sketch, which brackets every quantile.  The
    second counts what lies between the brackets and keeps what lies inside, a small
    share of the rows.  The counts show whether a bracket holds its quantile; if one does not,
    the whole column is sorted instead.  Brackets with many values are narrowed by the same
    means until a window sorts at most ``WINDOW_ROWS`` values.
    A quantile that is asked for twice gives two rows.
    """
    data = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    asked = [float(q) for q in quantiles]
    distinct = sorted(set(asked))
    found = _bracketed(data, keys, distinct, accuracy)
    if found is None:
        counted = data.groupBy(*keys, "__v").agg(F.count("*").alias("__w"))
        place = "q * (__total - 1)"
        wanted = (
            f"transform(array({', '.join(repr(q) + 'D' for q in distinct)}), q -> "
            f"named_struct('q', q, '__lo', floor({place}), '__hi', ceil({place}), "
            f"'__frac', {place} - floor({place})))"
        )
        found = _values_at(counted, keys, wanted)
    low, high = F.col("__low").cast("double"), F.col("__high").cast("double")
    # between equal infinities there is nothing to interpolate
    point = F.when((low == high) | (F.col("__frac") == 0), low).otherwise(low + (high - low) * F.col("__frac"))
    out = found.select(*keys, "q", point.alias(value))
    if len(distinct) < len(asked):
        times = F.create_map(*[F.lit(x) for q in distinct for x in (q, asked.count(q))])
        out = out.select("*", F.explode(F.sequence(F.lit(1), times[F.col("q")])).alias("__again")).drop("__again")
    return out


def _sketch_size(accuracy: int) -> int:
    return min(65535, max(8, accuracy // 5))


def _attach(rows: DataFrame, keys: Sequence[str], small: DataFrame, *names: str) -> DataFrame:
    """Columns of the one ``small`` row that has the row's keys."""
    if not keys:
        return rows.withColumns({n: small.select(n).scalar() for n in names})
    other = small.select(*[F.col(k).alias(f"__of_{k}") for k in keys], *names)
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys))
    return rows.join(other, same).drop(*[f"__of_{k}" for k in keys])


def _bracketed(
    data: DataFrame, keys: Sequence[str], quantiles: Sequence[float], accuracy: int
) -> DataFrame | None:
    """(keys, q, __frac, __low, __high) from the rows near each of the distinct quantiles, or None."""
    size = _sketch_size(accuracy)
    slack = 2 * 2.296 / size ** 0.9723      # twice the sketch's error of ranks at 99 % confidence
    points = sorted({p for q in quantiles for p in (q - slack, q + slack) if 0 < p < 1}) or [0.5]
    v = F.col("__v")
    found_points = F.kll_sketch_get_quantile_double("__sketch", F.array(*[F.lit(p) for p in points]))
    sketch = data.groupBy(*keys).agg(
        F.count("*").alias("__total"), F.count_if(~F.isnan(v)).alias("__fine"), F.kll_sketch_agg_double(v, F.lit(size)).alias("__sketch"))
    sketch = keep(
        sketch.withColumn("__points", F.when(F.col("__fine") > 0, found_points)).drop("__sketch", "__fine"), "sketch")

    def bound(p: float) -> Column:
        """Value at a sketched point; null (no bound) beyond both ends."""
        return F.get("__points", points.index(p)) if 0 < p < 1 else F.lit(None).cast("double")

    low = [bound(q - slack) for q in quantiles]
    high = [bound(q + slack) for q in quantiles]

    def inside(i: int) -> Column:
        return (low[i].isNull() | (v >= low[i])) & (high[i].isNull() | (v <= high[i]))

    # a row inside a bracket stands for itself, any other for the stretch behind the bound below it
    near = reduce(lambda a, b: a | b, (inside(i) for i in range(len(quantiles))))
    behind = F.array_max(F.filter("__points", lambda p: p < v))
    counted = keep(
        _attach(data, keys, sketch, "__points")
        .groupBy(*keys, near.alias("__in"), F.when(near, v).otherwise(behind).alias("__v")).agg(F.count("*").alias("__w")),
        "counted")

    def below(i: int) -> Column:
        return F.when(low[i].isNull(), F.lit(0)).otherwise(F.sum(F.when(v.isNull() | (v < low[i]), F.col("__w")).otherwise(F.lit(0))))

    placed = _attach(counted, keys, sketch, "__points", "__total")
    own = [F.col("__in") & inside(i) for i in range(len(quantiles))]
    summed = placed.groupBy(*keys, "__points", "__total").agg(
        F.array(*[below(i) for i in range(len(quantiles))]).alias("__below"),
        F.array(*[F.sum(F.when(o, F.col("__w")).otherwise(F.lit(0))) for o in own]).alias("__weight"),
        F.array(*[F.count_if(o) for o in own]).alias("__values"))

    def want(i: int, q: float) -> Column:
        place = F.lit(float(q)) * (F.col("__total") - 1)
        first, last = F.floor(place) - F.get("__below", i), F.ceil(place) - F.get("__below", i)
        return F.struct(
            F.lit(float(q)).alias("q"), low[i].alias("from"), high[i].alias("to"), first.alias("__lo"), last.alias("__hi"),
            (place - F.floor(place)).alias("__frac"), ((first >= 0) & (last < F.get("__weight", i))).alias("holds"),
            F.get("__values", i).alias("values"))

    brackets = keep(summed.select(*keys, F.array(*[want(i, q) for i, q in enumerate(quantiles)]).alias("__want")), "brackets")
    state = brackets.select(F.inline("__want")).agg(F.every("holds").alias("holds"), F.max("values").alias("most")).first()
    if state["holds"] is False:
        return None
    chosen = _attach(counted.where("__in"), keys, brackets, "__want").select(
        *keys, "__v", "__w", F.inline(F.filter(
            "__want", lambda w: (w["from"].isNull() | (v >= w["from"])) & (w["to"].isNull() | (v <= w["to"])))))
    chosen = chosen.select(*keys, "q", "__lo", "__hi", "__frac", "__v", "__w")
    most = state["most"] or 0
    while most > WINDOW_ROWS:
        chosen = _narrowed(chosen, [*keys, "q"], size)
        most = chosen.groupBy(*keys, "q").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    end = F.sum("__w").over(Window.partitionBy(*keys, "q").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    rows = chosen.withColumn("__end", end)

    def at(place: str) -> Column:
        here = (F.col(place) < F.col("__end")) & (F.col(place) >= F.col("__end") - F.col("__w"))
        return F.max(F.when(here, v))

    return rows.groupBy(*keys, "q", "__frac").agg(at("__lo").alias("__low"), at("__hi").alias("__high"))


def _narrowed(chosen: DataFrame, groups: Sequence[str], size: int) -> DataFrame:
    """The rows of each group in the cells that hold its wanted places, which are counted from
    the first of these cells.  A sketch of the values cuts a group into ``CELLS`` cells; their rows are counted
    exactly, so no place is lost however the sketch errs."""
    v = F.col("__v")
    points = F.kll_sketch_get_quantile_double("__sketch", F.array(*[F.lit(i / CELLS) for i in range(1, CELLS)]))
    cuts = chosen.groupBy(*groups).agg(F.kll_sketch_agg_double(v, F.lit(size)).alias("__sketch")).select(*groups, points.alias("__cuts"))
    celled = keep(
        _attach(chosen, groups, keep(cuts, "cuts"), "__cuts")
        .withColumn("__cell", F.size(F.filter("__cuts", lambda p: p < v))).drop("__cuts"), "cells")
    own = Window.partitionBy(*groups).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = celled.groupBy(*groups, "__cell", "__lo", "__hi").agg(F.sum("__w").alias("__n")).withColumn(
        "__before", F.coalesce(F.sum("__n").over(own), F.lit(0)))
    held = cells.where((F.col("__before") <= F.col("__hi")) & (F.col("__before") + F.col("__n") > F.col("__lo")))
    first = F.min("__before").over(Window.partitionBy(*groups))
    held = held.select(*groups, "__cell", first.alias("__start"))
    rows = _attach(celled, [*groups, "__cell"], held, "__start")
    return keep(rows.select(
        *groups, (F.col("__lo") - F.col("__start")).alias("__lo"), (F.col("__hi") - F.col("__start")).alias("__hi"), "__frac", "__v", "__w"), "narrowed")


def _values_at(counted: DataFrame, groups: Sequence[str], wanted: str) -> DataFrame:
    """(groups, q, __frac, __low, __high): the values at wanted places of each group.

    ``counted`` holds every value of a group once, with its number of rows
    ``__w``.  ``wanted`` is SQL for an array of (q, __lo, __hi, __frac) with
    places counted from 0; it may use ``__total``, the rows of the group.  Only
    the partitions that hold a wanted place are read a second time.
    """
    placed = _placed(counted, groups, ["__v"], "quantile")
    parts = placed.groupBy(_PART, *groups).agg(F.sum("__w").alias("__n"))
    per_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = per_group.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn(
        "__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    ).withColumn("__total", F.sum("__n").over(per_group))
    covers = "filter({array}, w -> (w.__lo >= {a} AND w.__lo < {b}) OR (w.__hi >= {a} AND w.__hi < {b}))"
    parts = keep(
        parts.withColumn("__all", F.expr(wanted))
        .withColumn(
            "__here", F.expr(covers.format(array="__all", a="__before", b="__before + __n"))
        )
        .where(F.size("__here") > 0)
        .select(_PART, *groups, "__before", "__here"),
        "quantile-parts",
    )
    rows = placed.join(parts, _same_keys(placed, parts, [_PART, *groups])).select(
        placed[_PART], *[placed[g] for g in groups], "__v", "__w", "__before", "__here"
    )
    upto = Window.partitionBy(_PART, *groups).orderBy("__v").rowsBetween(
        Window.unboundedPreceding, 0
    )
    rows = rows.withColumn("__end", F.col("__before") + F.sum("__w").over(upto)).withColumn(
        "__start", F.col("__end") - F.col("__w")
    )
    outer = [g for g in groups if g not in ("q", "__lo", "__hi", "__frac")]
    hits = rows.select(
        *outer, "__v", "__start", "__end",
        F.inline(F.expr(covers.format(array="__here", a="__start", b="__end"))),
    )

    def at(edge: str) -> Column:
        return F.max(F.when(F.expr(f"{edge} >= __start AND {edge} < __end"), F.col("__v")))

    return hits.groupBy(*outer, "q", "__frac").agg(
        at("__lo").alias("__low"), at("__hi").alias("__high")
    )

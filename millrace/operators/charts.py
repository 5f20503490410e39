"""The numbers behind charts, computed on the full data and not on a preview."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import exact_percentiles
from millrace.scratch import keep


def pivot_table(
    df: DataFrame, keys: Sequence[str], series: str, values: Sequence[str], cell: Column
) -> DataFrame:
    """Key by series; the series values are given, so no extra pass looks for them."""
    return df.groupBy(*keys).pivot(series, list(values)).agg(cell)


def series(df: DataFrame, keys: Sequence[str], **cells: Column) -> DataFrame:
    """One point per key: the data of bar, line and pie charts."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in cells.items()])


def shares(points: DataFrame, value: str, name: str = "share", scale: int = 6) -> DataFrame:
    """Adds each point's part of the total."""
    total = points.agg(F.sum(value)).scalar()
    return points.withColumn(name, F.round(F.col(value) / total, scale))


def map_codes(column: str, codes: Mapping[str, str], otherwise: str) -> Column:
    """Chart codes for the values of a column."""
    out = reduce(
        lambda acc, kv: acc.when(F.col(column) == kv[0], kv[1]),
        list(codes.items())[1:],
        F.when(F.col(column) == next(iter(codes)), next(iter(codes.values()))),
    )
    return out.otherwise(otherwise)


def bin_of(column: str, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 0 .. bins-1; the largest value belongs to the last bin."""
    width = (high - low) / F.lit(bins)
    place = F.floor((F.col(column) - low) / F.when(width != 0, width).otherwise(F.lit(1.0)))
    return F.least(place, F.lit(bins - 1)).cast("int")


def _range(df: DataFrame, column: str) -> tuple[Column, Column]:
    low = df.agg(F.min(column).cast("double")).scalar()
    high = df.agg(F.max(column).cast("double")).scalar()
    return low, high


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows (bin, n) for the bins that hold rows."""
    low, high = _range(df, column)
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(bin_of(column, low, high, bins).alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def density_2d(df: DataFrame, x: str, y: str, x_bins: int, y_bins: int) -> DataFrame:
    """Rows (x_bin, y_bin, n) on an equal-width grid."""
    return (
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(
            bin_of(x, *_range(df, x), x_bins).alias("x_bin"),
            bin_of(y, *_range(df, y), y_bins).alias("y_bin"),
        )
        .agg(F.count("*").alias("n"))
    )


def quantile_plot(
    df: DataFrame, value: str, quantiles: Sequence[float], keys: Sequence[str] = (),
) -> DataFrame:
    """Value at each quantile, one curve per key (0 to 2 keys)."""
    if len(keys) > 2:
        raise ValueError("a quantile plot has at most two keys")
    return exact_percentiles(df, keys, value, quantiles)


def quantile_plot_approx(
    df: DataFrame, value: str, quantiles: Sequence[float], keys: Sequence[str] = (),
    accuracy: int = 10_000,
) -> DataFrame:
    """The same from one pass with a sketch; rank error at most 1/accuracy."""
    qs = F.array(*[F.lit(float(q)) for q in quantiles])
    return (
        df.groupBy(*keys)
        .agg(F.percentile_approx(value, list(quantiles), accuracy).alias("__v"))
        .select(*keys, F.inline(F.arrays_zip(qs.alias("q"), F.col("__v").alias(value))))
    )


def qq_plot(
    df: DataFrame, value: str, other: str, quantiles: Sequence[float]
) -> DataFrame:
    """Quantiles of one field against quantiles of another: rows (q, value, other)."""
    fields = (value, other)
    stacked = df.select(
        F.inline(F.array(*[
            F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("v")) for f in fields
        ]))
    )
    points = exact_percentiles(stacked, ["field"], "v", quantiles)
    return points.groupBy("q").agg(*[
        F.max(F.when(F.col("field") == f, F.col("v"))).alias(f) for f in fields
    ])


def qq_normal(df: DataFrame, value: str, quantiles: Sequence[float]) -> DataFrame:
    """Quantiles of a field against those of the standard normal distribution."""
    normal = NormalDist()
    theory = F.create_map(*[
        F.lit(x) for q in quantiles for x in (float(q), float(normal.inv_cdf(q)))
    ])
    return exact_percentiles(df, [], value, quantiles).withColumn("normal", theory[F.col("q")])


def _boxes(df: DataFrame, value: str, keys: Sequence[str], reach: float) -> DataFrame:
    points = exact_percentiles(df, keys, value, (0.25, 0.5, 0.75))

    def at(q: float) -> Column:
        return F.max(F.when(F.col("q") == q, F.col(value)))

    boxes = points.groupBy(*keys).agg(
        at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3")
    )
    spread = (F.col("q3") - F.col("q1")) * F.lit(reach)
    return keep(
        boxes.withColumn("low_fence", F.col("q1") - spread).withColumn(
            "high_fence", F.col("q3") + spread
        ),
        "boxes",
    )


def _with_box(df: DataFrame, boxes: DataFrame, keys: Sequence[str]) -> DataFrame:
    small = boxes.withColumnsRenamed({k: f"__{k}" for k in keys})
    cond = reduce(
        lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys)
    )
    return df.join(small, cond).drop(*[f"__{k}" for k in keys])


def box_plot(
    df: DataFrame, value: str, keys: Sequence[str], reach: float = 1.5
) -> DataFrame:
    """One box per key: quartiles, whisker ends, number of outliers."""
    rows = df.where(F.col(value).isNotNull()).select(*keys, value)
    joined = _with_box(rows, _boxes(rows, value, keys, reach), keys)
    inside = (F.col(value) >= F.col("low_fence")) & (F.col(value) <= F.col("high_fence"))
    return joined.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("low_whisker"),
        F.max(F.when(inside, F.col(value))).alias("high_whisker"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(
    df: DataFrame, value: str, keys: Sequence[str], reach: float = 1.5
) -> DataFrame:
    """The rows beyond the fences of their key's box."""
    rows = df.where(F.col(value).isNotNull())
    joined = _with_box(rows, _boxes(rows, value, keys, reach), keys)
    outside = (F.col(value) < F.col("low_fence")) | (F.col(value) > F.col("high_fence"))
    return joined.where(outside).select(*df.columns)


def hash_below(keys: Sequence[str], fraction: float) -> Column:
    """True for a fixed share of keys.  The same key is always in or always out,
    on any cluster and in any engine with md5."""
    if not 0 <= fraction <= 1:
        raise ValueError("fraction lies between 0 and 1")
    if fraction == 1:
        return F.lit(True)
    bound = f"{int(fraction * 16**8):08x}"
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.substring(F.md5(text), 1, 8) < F.lit(bound)


def scatter_sample(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str], fraction: float
) -> DataFrame:
    """Points for a scatter plot: a repeatable sample of the rows by their key."""
    return df.where(hash_below(keys, fraction)).select(*fields)


def word_cloud(df: DataFrame, text: str, condition: str) -> DataFrame:
    """Word weights over the distinct texts that satisfy ``condition``."""
    return (
        df.where(condition)
        .select(text)
        .distinct()
        .select(F.explode(F.split(text, " ")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )

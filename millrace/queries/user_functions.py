"""User functions: external models, per-group fits, the pandas-style API."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.ml import group_models, scoring
from millrace.queries.registry import query, table


@query("udf_score", """
    SELECT l_orderkey, l_partkey,
           round(0.5 * l_quantity + 0.001 * l_extendedprice - 20 * l_discount + 3, 6) AS score
    FROM lineitem""")
def udf_score(spark, sf_dir):
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    model = scoring.linear_model([0.5, 0.001, -20.0], 3.0)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.round(scoring.score_column(model, names), 6).alias("score")
    )


@query("udf_group_fit", """
    SELECT l_returnflag, l_linestatus,
           round(regr_slope(l_extendedprice, l_quantity), 3) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 1) AS intercept, count(*) AS n
    FROM lineitem GROUP BY ALL""")
def udf_group_fit(spark, sf_dir):
    fits = scoring.fit_per_group(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_quantity"],
        "l_extendedprice",
    )
    return fits.select(
        "l_returnflag", "l_linestatus", F.round(F.col("coefficients")[0], 3).alias("slope"),
        F.round("intercept", 1).alias("intercept"), "n",
    )


_SIDE = "CASE WHEN l_orderkey % 10 > 0 THEN 'most' ELSE l_returnflag END"


@query("udf_group_stream", f"""
    SELECT {_SIDE} AS side, round(regr_slope(l_extendedprice, l_quantity), 3) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 1) AS intercept,
           round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, count(*) AS n
    FROM lineitem GROUP BY ALL""")
def udf_group_stream(spark, sf_dir):
    """A model per group by Python functions that see a group as a stream; one group has nine
    tenths of the rows."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(f"{_SIDE} AS side", "l_quantity", "l_extendedprice")
    fits = group_models.fit_streamed(lines, ["side"], ["l_quantity"], "l_extendedprice")
    return fits.select(
        "side", F.round(F.col("coefficients")[0], 3).alias("slope"), F.round("intercept", 1).alias("intercept"),
        F.round("r2", 6).alias("r2"), "n")


@query("pandas_api_describe", """
    SELECT 'count' AS stat, CAST(count(value) AS DOUBLE) AS value, CAST(count(user_id) AS DOUBLE) AS user_id FROM events
    UNION ALL SELECT 'mean', round(avg(value), 4), round(avg(user_id), 4) FROM events
    UNION ALL SELECT 'std', round(stddev_samp(value), 4), round(stddev_samp(user_id), 4) FROM events
    UNION ALL SELECT 'min', min(value), CAST(min(user_id) AS DOUBLE) FROM events
    UNION ALL SELECT 'max', max(value), CAST(max(user_id) AS DOUBLE) FROM events""")
def pandas_api_describe(spark, sf_dir):
    frame = table(spark, sf_dir, "events").select("value", "user_id").pandas_api()
    stats = frame.describe().to_spark(index_col="stat")
    return stats.where("stat IN ('count', 'mean', 'std', 'min', 'max')").select(
        "stat", F.round("value", 4).alias("value"), F.round("user_id", 4).alias("user_id")
    )

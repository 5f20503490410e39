"""Chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import charts, ordered
from millrace.queries.registry import query, table

QS = (0.0, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0)
_QS_SQL = ", ".join(str(q) for q in QS)


@query("agg_pivot", """
    SELECT l_returnflag,
           round(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END), 2) AS "F",
           round(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END), 2) AS "O"
    FROM lineitem GROUP BY l_returnflag""")
def agg_pivot(spark, sf_dir):
    return charts.pivot_table(
        table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_linestatus", ["F", "O"],
        F.round(F.sum("l_quantity"), 2),
    )


@query("agg_series", """
    SELECT month(l_shipdate)::INTEGER AS month, l_returnflag, round(sum(l_quantity), 2) AS quantity,
           count(*) AS n
    FROM lineitem GROUP BY 1, 2""")
def agg_series(spark, sf_dir):
    return charts.series(
        table(spark, sf_dir, "lineitem").withColumn("month", F.month("l_shipdate")),
        ["month", "l_returnflag"],
        quantity=F.round(F.sum("l_quantity"), 2), n=F.count("*"),
    )


@query("agg_share", """
    SELECT c_mktsegment, count(*) AS n,
           round(count(*) / (SELECT count(*) FROM customer), 6) AS share
    FROM customer GROUP BY c_mktsegment""")
def agg_share(spark, sf_dir):
    points = charts.series(table(spark, sf_dir, "customer"), ["c_mktsegment"], n=F.count("*"))
    return charts.shares(points, "n")


@query("agg_geo", """
    SELECT CASE WHEN lang = 'en' THEN 'GBR' WHEN lang = 'de' THEN 'DEU' ELSE 'FRA' END AS country_code,
           count(*) AS n, round(avg(n_chars), 6) AS avg_chars
    FROM documents GROUP BY 1""")
def agg_geo(spark, sf_dir):
    code = charts.map_codes("lang", {"en": "GBR", "de": "DEU"}, "FRA")
    return charts.series(
        table(spark, sf_dir, "documents").withColumn("country_code", code), ["country_code"],
        n=F.count("*"), avg_chars=F.round(F.avg("n_chars"), 6),
    )


@query("agg_histogram", """
    WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
    SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin,
           count(*) AS n
    FROM lineitem, r GROUP BY 1""")
def agg_histogram(spark, sf_dir):
    return charts.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 20)


_QUANTILES = f"""
    SELECT l_returnflag, unnest([{_QS_SQL}])::DOUBLE AS q,
           round(unnest(quantile_cont(l_extendedprice, [{_QS_SQL}])), 6) AS l_extendedprice
    FROM lineitem GROUP BY l_returnflag"""


@query("agg_quantiles", _QUANTILES)
def agg_quantiles(spark, sf_dir):
    points = charts.quantile_plot(
        table(spark, sf_dir, "lineitem"), "l_extendedprice", QS, ["l_returnflag"]
    )
    return points.withColumn("l_extendedprice", F.round("l_extendedprice", 6))


@query("agg_quantiles_approx", f"""
    SELECT l_returnflag, unnest([{_QS_SQL}])::DOUBLE AS q, true AS in_bounds
    FROM (SELECT DISTINCT l_returnflag FROM lineitem)""")
def agg_quantiles_approx(spark, sf_dir):
    """Whether each value's rank is within 1 / accuracy of what was asked for."""
    lines, accuracy = table(spark, sf_dir, "lineitem"), 10_000
    points = charts.quantile_plot_approx(lines, "l_extendedprice", QS, ["l_returnflag"], accuracy)
    points = points.withColumnRenamed("l_extendedprice", "found")
    ranks = lines.join(F.broadcast(points), "l_returnflag").groupBy("l_returnflag", "q").agg(
        F.avg((F.col("l_extendedprice") < F.col("found")).cast("int")).alias("below"),
        F.avg((F.col("l_extendedprice") <= F.col("found")).cast("int")).alias("upto"), F.count("*").alias("n"),
    )
    slack = F.lit(1.0) / accuracy + 1 / F.col("n")
    return ranks.select("l_returnflag", "q", (
        (F.col("below") - slack <= F.col("q")) & (F.col("q") <= F.col("upto") + slack)).alias("in_bounds"))


@query("agg_qq_normal", """
    SELECT q, round(v, 6) AS l_quantity, round(n, 4)::DOUBLE AS normal
    FROM (SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9])::DOUBLE AS q,
                 unnest(quantile_cont(l_quantity, [0.1, 0.25, 0.5, 0.75, 0.9])) AS v,
                 unnest([-1.2815515655446004, -0.6744897501960817, 0.0, 0.6744897501960817, 1.2815515655446004]) AS n
          FROM lineitem)""")
def agg_qq_normal(spark, sf_dir):
    points = charts.qq_normal(table(spark, sf_dir, "lineitem"), "l_quantity", (0.1, 0.25, 0.5, 0.75, 0.9))
    return points.select("q", F.round("l_quantity", 6).alias("l_quantity"), F.round("normal", 4).alias("normal"))


@query("agg_qq", f"""
    SELECT unnest([{_QS_SQL}])::DOUBLE AS q,
           round(unnest(quantile_cont(l_quantity, [{_QS_SQL}])), 6) AS l_quantity,
           round(unnest(quantile_cont(l_extendedprice, [{_QS_SQL}])), 6) AS l_extendedprice
    FROM lineitem""")
def agg_qq(spark, sf_dir):
    points = charts.qq_plot(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", QS)
    return points.select(
        "q", F.round("l_quantity", 6).alias("l_quantity"),
        F.round("l_extendedprice", 6).alias("l_extendedprice"),
    )


_BOX = """
    WITH b AS (
      SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3
      FROM events GROUP BY event_type),
    e AS (
      SELECT ev.*, q1, median, q3, q1 - (q3 - q1) * 1.5 AS lo, q3 + (q3 - q1) * 1.5 AS hi
      FROM events ev JOIN b USING (event_type))"""


@query("agg_box", _BOX + """
    SELECT event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           min(CASE WHEN value >= lo AND value <= hi THEN value END) AS low_whisker,
           max(CASE WHEN value >= lo AND value <= hi THEN value END) AS high_whisker,
           count(*) FILTER (WHERE value < lo OR value > hi) AS outliers
    FROM e GROUP BY ALL""")
def agg_box(spark, sf_dir):
    boxes = charts.box_plot(table(spark, sf_dir, "events"), "value", ["event_type"])
    return boxes.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query("agg_box_outliers", _BOX + """
    SELECT event_id, event_type, value FROM e WHERE value < lo OR value > hi""")
def agg_box_outliers(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return charts.box_outliers(events, "value", ["event_type"])


@query("agg_density2d", """
    WITH r AS (SELECT min(l_quantity) AS lx, max(l_quantity) AS hx,
                      min(l_extendedprice) AS ly, max(l_extendedprice) AS hy FROM lineitem)
    SELECT CAST(least(floor((l_quantity - lx) / ((hx - lx) / 10)), 9) AS INTEGER) AS x_bin,
           CAST(least(floor((l_extendedprice - ly) / ((hy - ly) / 12)), 11) AS INTEGER) AS y_bin,
           count(*) AS n
    FROM lineitem, r GROUP BY 1, 2""")
def agg_density2d(spark, sf_dir):
    return charts.density_2d(
        table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", 10, 12
    )


@query("scatter_sample", """
    SELECT o_custkey, o_totalprice, o_orderpriority, o_orderstatus FROM orders""")
def scatter_sample(spark, sf_dir):
    return charts.scatter_sample(
        table(spark, sf_dir, "orders"), ["o_orderkey"],
        ["o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus"], 1,
    )


@query("word_cloud", """
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split(text, ' ')) AS word
          FROM (SELECT DISTINCT text FROM documents WHERE lang = 'en'))
    GROUP BY word""")
def word_cloud(spark, sf_dir):
    return charts.word_cloud(table(spark, sf_dir, "documents"), "text", "lang == 'en'")


_POSITIONS = """
    SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_partkey,
           row_number() OVER (PARTITION BY l_returnflag, l_linestatus
             ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS position
    FROM lineitem"""


@query("win_row_position", _POSITIONS)
def win_row_position(spark, sf_dir):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    keys = ["l_returnflag", "l_linestatus"]
    rows = table(spark, sf_dir, "lineitem").select(*keys, *order)
    return ordered.row_position(rows, keys, order).drop("l_suppkey", "l_shipdate")

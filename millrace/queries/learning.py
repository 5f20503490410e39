"""Learning: fits return (metric, value) rows, scoring returns predictions."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace import scratch
from millrace.ml import features, models, scoring
from millrace.ml.forest_search import GRID, halving_search
from millrace.ml.top_items import ITEM_BLOCK as BLOCK
from millrace.queries.registry import query, table, texts
from millrace.queries.features import STOP_WORDS


# A line's worth: mostly its quantity, with the price (which knows nothing of the quantity in
# these tables) as noise.  Learners that work find the quantity.
_WORTH = "(l_quantity * 1000 + l_extendedprice / 10)"


def _lines(spark, sf_dir):
    """features = [quantity / stddev], label = worth; keys for the split."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_shipdate", "l_quantity",
        F.expr(_WORTH).alias("label"),
    )
    vectors = features.assembler(["l_quantity"], "raw").transform(rows)
    scaled = features.scaler("raw", "features").fit(vectors).transform(vectors)
    return scaled.select("l_orderkey", "l_partkey", "l_shipdate", "features", "label")


def _labelled(spark, sf_dir):
    """features = [quantity, discount], label = whether the worth is high."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_discount",
        F.expr(f"double({_WORTH} > 30000)").alias("label"),
    )
    vectors = features.assembler(["l_quantity", "l_discount"], "features").transform(rows)
    return vectors.select("l_orderkey", "l_partkey", "features", "label")


_TEST = "substr(md5(l_orderkey || '|' || l_partkey), 1, 8) >= '{bound}'"
_N_TEST = f"SELECT 'n' AS metric, count(*)::DOUBLE AS value FROM lineitem WHERE {_TEST}"


def _laws(*names: str, bound: str = "cccccccc") -> str:
    """SQL: as many predictions as there are test rows, and every law holds."""
    return _N_TEST.format(bound=bound) + "".join(f" UNION ALL SELECT '{n}', 1.0::DOUBLE" for n in names)


def _split_lines(spark, sf_dir):
    return models.stable_split(
        models.prepared(_lines(spark, sf_dir)), ["l_orderkey", "l_partkey"], 0.8
    )


def _regress(spark, sf_dir, learner):
    """Number of predictions for the test rows; whether they explain most of the variance."""
    train, test = _split_lines(spark, sf_dir)
    model = learner.fit(train)
    predicted = model.transform(test)
    r2 = models.regression_metrics(predicted)["r2"]
    return model, models.metric_rows(spark, {"n": predicted.count(), "explains_most": r2 > 0.5})


def _classify(spark, sf_dir, learner):
    """Number of predictions for the test rows; whether far more are right than the commoner
    label would give."""
    train, test = models.stable_split(
        models.prepared(_labelled(spark, sf_dir)), ["l_orderkey", "l_partkey"], 0.8)
    predicted = learner.fit(train).transform(test)
    high = test.agg(F.avg("label")).first()[0]
    right = models.class_metrics(predicted)["accuracy"]
    return models.metric_rows(spark, {"n": predicted.count(), "beats_constant": right > max(high, 1 - high) + 0.1})


@query("ml_linreg", "SELECT 'n' AS metric, count(*)::DOUBLE AS value FROM lineitem"
       " UNION ALL SELECT 'near_plain_slope', 1.0::DOUBLE UNION ALL SELECT 'explains_most', 1.0::DOUBLE")
def ml_linreg(spark, sf_dir):
    """With the jobs' penalties, which hardly move a slope of thousands."""
    lines = models.prepared(_lines(spark, sf_dir))
    model = models.linear_regression().fit(lines)
    plain = models.linear_regression(regParam=0.0, elasticNetParam=0.0, solver="normal").fit(lines)
    near = abs(model.coefficients[0] / plain.coefficients[0] - 1) < 0.01
    return models.metric_rows(spark, {
        "n": model.summary.numInstances, "near_plain_slope": near, "explains_most": model.summary.r2 > 0.5})


@query("ml_linreg_plain", """
    SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept,
           round(regr_r2(l_extendedprice, l_quantity), 6) AS r2
    FROM lineitem""")
def ml_linreg_plain(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_quantity", "l_extendedprice AS label")
    vectors = features.assembler(["l_quantity"], "features").transform(rows)
    model = models.linear_regression(regParam=0.0, elasticNetParam=0.0, solver="normal").fit(vectors)
    found = [(float(model.coefficients[0]), float(model.intercept), float(model.summary.r2))]
    return spark.createDataFrame(found, "slope double, intercept double, r2 double").select(
        F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"),
        F.round("r2", 6).alias("r2"),
    )


@query("ml_dt_reg", _laws("explains_most", "text_names_every_node"))
def ml_dt_reg(spark, sf_dir):
    model, metrics = _regress(spark, sf_dir, models.tree_regressor())
    text = model.toDebugString
    leaves, splits = text.count("Predict:"), text.count("If (")
    whole = leaves + splits == model.numNodes
    return metrics.union(models.metric_rows(spark, {"text_names_every_node": whole}))


@query("ml_tree_text", """
    SELECT true AS numbered, 1::BIGINT AS headers""")
def ml_tree_text(spark, sf_dir):
    """The tree as text, a row a line: its first line names the model."""
    model, _ = _regress(spark, sf_dir, models.tree_regressor())
    lines = models.text_rows(spark, model)
    return lines.agg(
        (F.max("line") + 1 == F.count("*")).alias("numbered"),
        F.count_if(F.col("text").startswith("DecisionTreeRegressionModel")).alias("headers"))


@query("ml_logreg", """
    SELECT 'auc' AS metric, 0.5::DOUBLE AS value UNION ALL SELECT 'coefficients', 0.0::DOUBLE
    UNION ALL SELECT 'auc_light_penalty_high', 1.0::DOUBLE UNION ALL SELECT 'roc_rises', 1.0::DOUBLE""")
def ml_logreg(spark, sf_dir):
    """The jobs' penalty (0.9 * 0.6) is larger than any slope of the loss of a label of 0 and 1
    can be, at most 0.5, so it leaves a constant model; a light one finds the signal."""
    rows = models.prepared(_labelled(spark, sf_dir).withColumn("name", F.col("label").cast("string")))
    stages = Pipeline(stages=[
        features.StringIndexer(inputCol="name", outputCol="target", handleInvalid="skip"),
        models.logistic_regression("target"),
    ])
    model = stages.fit(rows).stages[-1]
    light = models.logistic_regression(regParam=0.01).fit(rows)
    roc = light.summary.roc.collect()
    rises = all(a["FPR"] <= b["FPR"] and a["TPR"] <= b["TPR"] for a, b in zip(roc, roc[1:]))
    auc = models.ranking_metrics(light.transform(rows), bins=0)["auc"]
    return models.metric_rows(spark, {
        "auc": model.summary.areaUnderROC, "coefficients": sum(abs(c) for c in model.coefficients),
        "auc_light_penalty_high": auc > 0.9, "roc_rises": rises})


@query("ml_logreg_multi", """
    SELECT 'classes' AS metric, 3.0::DOUBLE AS value UNION ALL SELECT 'has_signal', 1.0::DOUBLE
    UNION ALL SELECT 'beats_constant', 1.0::DOUBLE""")
def ml_logreg_multi(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_discount",
        F.expr(f"CASE WHEN {_WORTH} < 20000 THEN 'low' WHEN {_WORTH} < 40000 THEN 'middle' ELSE 'high' END").alias("band"),
    )
    indexed = features.string_index(lines, "band", "label").transform(lines)
    train = models.prepared(
        features.assembler(["l_quantity", "l_discount"], "features").transform(indexed).select("features", "label"))
    model = models.multinomial_regression().fit(train)
    commonest = train.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]
    return models.metric_rows(spark, {
        "classes": model.numClasses, "has_signal": abs(model.coefficientMatrix.toArray()).max() > 0,
        "beats_constant": model.summary.accuracy > commonest})


@query("ml_dt_cls", _laws("beats_constant"))
def ml_dt_cls(spark, sf_dir):
    return _classify(spark, sf_dir, models.tree_classifier())


@query("ml_nb", f"""
    SELECT CAST({_WORTH} > 30000 AS INTEGER) AS class, round(avg(l_quantity), 4) AS mean_quantity,
           round(var_pop(l_quantity), 3) AS var_quantity, round(avg(l_discount), 6) AS mean_discount,
           round(count(*) / (SELECT count(*) FROM lineitem), 6) AS prior
    FROM lineitem GROUP BY 1""")
def ml_nb(spark, sf_dir):
    model = models.naive_bayes().fit(_labelled(spark, sf_dir))
    theta, sigma = model.theta.toArray(), model.sigma.toArray()
    found = [(c, float(theta[c][0]), float(sigma[c][0]), float(theta[c][1]), float(model.pi[c])) for c in range(2)]
    return spark.createDataFrame(found, "class int, m double, v double, d double, p double").select(
        "class", F.round("m", 4).alias("mean_quantity"), F.round("v", 3).alias("var_quantity"),
        F.round("d", 6).alias("mean_discount"), F.round(F.exp("p"), 6).alias("prior"))


@query("ml_svm", _laws("beats_constant"))
def ml_svm(spark, sf_dir):
    return _classify(spark, sf_dir, models.linear_svm())


@query("ml_rf_reg", _laws("explains_most"))
def ml_rf_reg(spark, sf_dir):
    return _regress(spark, sf_dir, models.forest_regressor())[1]


@query("ml_rf_cls", _laws("beats_constant"))
def ml_rf_cls(spark, sf_dir):
    return _classify(spark, sf_dir, models.forest_classifier())


@query("ml_gbt_reg", _laws("explains_most"))
def ml_gbt_reg(spark, sf_dir):
    return _regress(spark, sf_dir, models.boosted_regressor())[1]


@query("ml_gbt_cls", _laws("beats_constant"))
def ml_gbt_cls(spark, sf_dir):
    return _classify(spark, sf_dir, models.boosted_classifier())


_CLUSTERS = """
    SELECT 'n' AS metric, count(*)::DOUBLE AS value FROM lineitem
    UNION ALL SELECT 'clusters', 3.0::DOUBLE UNION ALL SELECT 'misplaced', 0.0::DOUBLE
    UNION ALL SELECT 'separated', 1.0::DOUBLE"""


def _clustered(spark, sf_dir, learner, nearest: bool):
    """Rows in clusters, number of clusters, rows that are nearer to another centre (flat
    clusters only), whether the silhouette shows clusters at all."""
    rows = models.prepared(_lines(spark, sf_dir).select("features"))
    model = learner.fit(rows)
    placed = model.transform(rows)
    centres = F.array(*[F.lit(float(c[0])) for c in model.clusterCenters()])
    far = F.transform(centres, lambda c: F.abs(c - features.vector_to_array("features")[0]))
    wrong = F.get(far, F.col("prediction")) > F.array_min(far) + 1e-9
    sizes = placed.agg(F.count("prediction"), F.count_distinct("prediction"), F.count_if(wrong)).first()
    shape = models.silhouette(placed)["silhouette"] > 0.4
    return models.metric_rows(spark, {
        "n": sizes[0], "clusters": sizes[1], "misplaced": sizes[2] if nearest else 0, "separated": shape})


@query("ml_kmeans", _CLUSTERS)
def ml_kmeans(spark, sf_dir):
    return _clustered(spark, sf_dir, models.k_means(), nearest=True)


@query("ml_bisecting", _CLUSTERS)
def ml_bisecting(spark, sf_dir):
    return _clustered(spark, sf_dir, models.bisecting_k_means(), nearest=False)


def _topics(spark, sf_dir):
    """Model, counted documents, vocabulary: all terms that two documents have."""
    docs = texts(spark, sf_dir, "doc_id", "text")
    terms = features.tokenizer("text", "terms").transform(docs)
    kept = features.stop_words_remover("terms", "kept", STOP_WORDS).transform(terms)
    vocabulary = features.vocabulary_table(kept, "kept", min_df=2)
    counter = features.TermCounter(vocabulary, "kept", "features")
    counts = models.prepared(counter.transform(kept.select("doc_id", "kept")))
    return models.topics().fit(counts), counts, vocabulary


@query("ml_lda", """
    SELECT unnest([0, 1])::INTEGER AS topic, 3::BIGINT AS terms, true AS falling""")
def ml_lda(spark, sf_dir):
    """Three terms a topic, the heaviest first."""
    model, _, vocabulary = _topics(spark, sf_dir)
    found = model.describeTopics(3).collect()
    words = dict(vocabulary.where(F.col("idx").isin([i for r in found for i in r.termIndices])).select("idx", "term").collect())
    rows = [(r.topic, [words[i] for i in r.termIndices], [float(w) for w in r.termWeights]) for r in found]
    frame = spark.createDataFrame(rows, "topic int, words array<string>, weights array<double>")
    return frame.select("topic", F.size(F.array_distinct("words")).cast("bigint").alias("terms"),
                        (F.col("weights") == F.sort_array("weights", asc=False)).alias("falling"))


@query("ml_lda_mix", "SELECT doc_id, 2::INTEGER AS topics, true AS sums_to_one FROM documents")
def ml_lda_mix(spark, sf_dir):
    """Every document's mix of topics."""
    model, counts, _ = _topics(spark, sf_dir)
    mix = F.col("topicDistribution")
    total = F.aggregate(mix, F.lit(0.0), lambda a, x: a + x)
    blank = total == 0  # a document without a known term has no mix
    return model.transform(counts).select("doc_id", F.size(mix).alias("topics"), ((F.abs(total - 1) < 1e-6) | blank).alias("sums_to_one"))


@query("ml_gmm", """
    SELECT 3::BIGINT AS parts, 1.0::DOUBLE AS weights, round(avg(l_quantity) / stddev_samp(l_quantity), 2) AS mean
    FROM lineitem""")
def ml_gmm(spark, sf_dir):
    """Weights sum to one, the parts' means average to the rows' mean."""
    rows = models.prepared(models.weighted(_lines(spark, sf_dir), ["features"]))
    model = models.gaussian_mixture(weightCol="weight").fit(rows)
    found = [(i, float(w), float(g.mean[0])) for i, (w, g) in enumerate(zip(model.weights, model.gaussians))]
    parts = spark.createDataFrame(found, "part int, weight double, mean double")
    return parts.agg(F.count("*").alias("parts"), F.round(F.sum("weight"), 6).alias("weights"),
                     F.round(F.sum(F.col("weight") * F.col("mean")), 2).alias("mean"))


def _purchases(spark, sf_dir):
    """Customer, part and quantity as text; every order's status letter spoils some ids."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("C"), "o_custkey"))
        .otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        F.col("l_partkey").cast("string").alias("part"),
        F.col("l_quantity").cast("string").alias("quantity"),
    )


def _ratings(spark, sf_dir):
    whole = _purchases(spark, sf_dir).withColumn(
        "quantity", F.split_part("quantity", F.lit("."), F.lit(1))
    )
    return models.ratings(whole, "customer", "part", "quantity")


@query("ml_ratings", """
    SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS item_id,
           CAST(l_quantity AS INTEGER) AS rating
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'""")
def ml_ratings(spark, sf_dir):
    return _ratings(spark, sf_dir)


_PAIRS = """
    WITH r AS (SELECT o_custkey AS u, l_partkey AS i, CAST(l_quantity AS INTEGER) AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey
               WHERE o_orderstatus <> 'P')"""


@query("ml_als", _PAIRS + """,
    s AS (SELECT *, substr(md5(u || '|' || i), 1, 8) < 'b3333333' AS train FROM r),
    p AS (SELECT q FROM s WHERE NOT train AND u IN (SELECT u FROM s WHERE train) AND i IN (SELECT i FROM s WHERE train))
    SELECT 'n' AS metric, count(*)::DOUBLE AS value FROM p UNION ALL SELECT 'mean', round(avg(q), 6) FROM p
    UNION ALL SELECT 'train_rows', count(*)::DOUBLE FROM s WHERE train
    UNION ALL SELECT 'train_mean', round(avg(q), 6) FROM s WHERE train UNION ALL SELECT 'learns', 1.0::DOUBLE""")
def ml_als(spark, sf_dir):
    """Predictions for the test pairs whose two sides were trained; those of others drop out.  On
    the rows that it saw the model errs less than their mean would."""
    train, test = models.stable_split(
        models.prepared(_ratings(spark, sf_dir)), ["user_id", "item_id"], 0.7
    )
    model = models.factors().fit(train)
    predicted = model.transform(test)
    own = train.agg(F.count("*"), F.avg("rating"), F.stddev_pop("rating")).first()
    met = predicted.agg(F.count("*"), F.avg("rating")).first()
    rmse = models.regression_metrics(model.transform(train), "rating")["rmse"]
    return models.metric_rows(spark, {
        "n": met[0], "mean": round(met[1], 6), "train_rows": own[0], "train_mean": round(own[1], 6), "learns": rmse < own[2]})


@query("ml_recommend", _PAIRS + """
    SELECT 'user' AS of, count(DISTINCT u) * 5 AS n, true AS known, true AS distinct_five, true AS falling, true AS bounded FROM r
    UNION ALL SELECT 'item', count(DISTINCT i) * 5, true, true, true, true FROM r""")
def ml_recommend(spark, sf_dir):
    """Five items a user and five users an item, all of them known, the best first, and the rest no
    better than the fifth: no more blocks were met than there are."""
    ratings = models.prepared(_ratings(spark, sf_dir))
    model = models.factors().fit(ratings)

    def laws(best, of, own, other):
        others = ratings.select(other).distinct()
        blocks = others.count() // BLOCK + 1
        known = best.join(others.withColumn("known", F.lit(True)), other, "left")
        before = F.lag("rating").over(Window.partitionBy(own).orderBy("rank"))
        per = known.withColumn("fell", F.coalesce(before >= F.col("rating"), F.lit(True))).groupBy(own).agg(
            F.count("*").alias("n"), F.every(F.coalesce("known", F.lit(False))).alias("known"),
            F.count_distinct(other).alias("distinct"), F.every("fell").alias("falling"), F.max("blocks").alias("blocks"))
        return per.agg(F.sum("n").alias("n"), F.every("known").alias("known"), F.every(F.col("distinct") == 5).alias("distinct_five"),
                       F.every("falling").alias("falling"), (F.max("blocks") <= blocks).alias("bounded")).select(
            F.lit(of).alias("of"), "n", "known", "distinct_five", "falling", "bounded")

    return laws(models.top_items(model), "user", "user_id", "item_id").union(
        laws(models.top_users(model), "item", "item_id", "user_id"))


@query("ml_split", """
    SELECT CASE WHEN substr(md5(l_orderkey || '|' || l_partkey), 1, 8) < 'cccccccc' THEN 'train'
                ELSE 'test' END AS side,
           count(*) AS n, round(sum(l_quantity), 2) AS quantity
    FROM lineitem GROUP BY 1""")
def ml_split(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    train, test = models.stable_split(lines, ["l_orderkey", "l_partkey"], 0.8)
    sides = train.withColumn("side", F.lit("train")).union(test.withColumn("side", F.lit("test")))
    return sides.groupBy("side").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query("ml_metrics", """
    WITH p AS (SELECT l_extendedprice AS y, l_quantity * 2000.0::DOUBLE AS f FROM lineitem)
    SELECT 'rmse' AS metric, round(sqrt(avg((y - f) * (y - f))), 4) AS value FROM p
    UNION ALL SELECT 'mae', round(avg(abs(y - f)), 4) FROM p
    UNION ALL SELECT 'r2', round(1 - sum((y - f) * (y - f)) /
        (SELECT sum((y - (SELECT avg(y) FROM p)) * (y - (SELECT avg(y) FROM p))) FROM p), 4) FROM p
    UNION ALL SELECT 'accuracy', round(avg(CASE WHEN (y > 50000) = (f > 50000) THEN 1 ELSE 0 END), 4) FROM p
    UNION ALL (
      WITH r AS (SELECT y > 50000 AS hit, rank() OVER (ORDER BY f) AS low,
                        count(*) OVER (PARTITION BY f) AS ties FROM p)
      SELECT 'auc', round((sum(low + (ties - 1) / 2.0) FILTER (WHERE hit) - count(*) FILTER (WHERE hit) * (count(*) FILTER (WHERE hit) + 1) / 2.0)
                          / (count(*) FILTER (WHERE hit) * count(*) FILTER (WHERE NOT hit)), 4) FROM r)""")
def ml_metrics(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("label"),
        (F.col("l_quantity") * F.lit(2000.0)).alias("prediction"),
    )
    found = models.regression_metrics(rows)
    high = rows.select(*[
        (F.col(c) > 50000).cast("double").alias(c) for c in ("label", "prediction")
    ])
    found["accuracy"] = models.class_metrics(high)["accuracy"]
    scored = rows.select((F.col("label") > 50000).cast("double").alias("label"), "prediction")
    found |= models.ranking_metrics(scored, score="prediction", bins=0)
    return models.metric_rows(spark, found).withColumn("value", F.round("value", 4))


@query("ml_cv", _laws("settings_12", "best_wins", "explains_most", bound="e6666666"))
def ml_cv(spark, sf_dir):
    """The best of a grid, and how it does on the tenth of the rows that the search never saw.  The search
    goes over the moments of the labels by fold and features, which lines have few of."""
    train, test = models.stable_split(
        models.prepared(_lines(spark, sf_dir)), ["l_orderkey", "l_partkey"], 0.9
    )
    grid = {"regParam": [0.1, 0.01], "fitIntercept": [False, True],
            "elasticNetParam": [0.0, 0.5, 1.0]}
    learner = models.linear_regression(weightCol="weight")
    folded = train.withColumn("fold", models.fold_of(["l_orderkey", "l_partkey"], 2))
    best, tried = models.grid_search(
        learner, models.regression_evaluator(weightCol="weight"), models.prepared(models.moments(folded, ["fold", "features"])), grid, fold="fold")
    predicted = best.transform(test)
    found = tried.agg(F.count("*"), F.min_by("setting", "metric")).first()
    return models.metric_rows(spark, {
        "n": predicted.count(), "settings_12": found[0] == 12,
        "best_wins": f"fitIntercept={best.getFitIntercept()}" in found[1],
        "explains_most": models.regression_metrics(predicted)["r2"] > 0.5})


_GRID_SQL = ", ".join(
    f"(SELECT unnest({[str(v) for v in values]}) AS {name})" for name, values in GRID.items())


@query("ml_forest_cv", f"""
    WITH RECURSIVE grid AS (SELECT count(*) AS n FROM {_GRID_SQL}),
    rungs(rung, settings) AS (
      SELECT 0, n FROM grid UNION ALL SELECT rung + 1, greatest(2, settings // 3) FROM rungs WHERE settings > 2),
    r AS (SELECT count(*) AS n, sum(CAST({_WORTH} > 30000 AS INTEGER)) / count(*) AS high FROM lineitem)
    SELECT rung, settings, CASE WHEN settings > 2 THEN least(n, CAST(1000 * 3 ** rung AS BIGINT)) ELSE n END AS rows,
           true AS shares, true AS learns
    FROM rungs, r""")
def ml_forest_cv(spark, sf_dir):
    """The whole grid on a thousand rows, a third of it on three times as many, and so on; the last two on
    all rows.  How many settings each rung had, whether the best is right far more often than the
    commoner label is."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "double(l_linenumber) AS number",
        "double(month(l_shipdate)) AS month", f"double({_WORTH} > 30000) AS label")
    vectors = features.assembler(["l_quantity", "l_discount", "l_tax", "number", "month"], "features").transform(rows)
    train = models.prepared(vectors.select("l_orderkey", "l_partkey", "l_linenumber", "features", "label"))
    found = halving_search(train, ["l_orderkey", "l_partkey", "l_linenumber"])
    high = train.agg(F.avg("label")).first()[0]
    return found.tried.groupBy("rung").agg(
        F.count_distinct("setting").alias("settings"), F.max("rows").alias("rows"), F.every(F.col("metric").between(0, 1)).alias("shares"),
        (F.max("metric") > max(high, 1 - high) + 0.1).alias("learns"))


@query("ml_batch_score", """
    SELECT l_orderkey, l_partkey, round(b + a * l_quantity, 2) AS predicted
    FROM lineitem, (SELECT regr_slope(l_extendedprice, l_quantity) AS a,
                           regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)""")
def ml_batch_score(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"
    )
    learner = models.linear_regression(
        "l_extendedprice", regParam=0.0, elasticNetParam=0.0, solver="normal"
    )
    model = Pipeline(stages=[features.assembler(["l_quantity"], "features"), learner]).fit(rows)
    path = scratch.new_path(spark, "model")
    scoring.save_model(model, path)
    scored = scoring.score_table(
        scoring.load_model(path), rows, scratch.new_path(spark, "scored")
    )
    return scored.select("l_orderkey", "l_partkey", F.round("prediction", 2).alias("predicted"))

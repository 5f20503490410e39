"""Learners with their settings, and the numbers that describe a fit.

Training frames are written once (``prepared``): iterative learners read them
many times, and a re-run of joins and feature steps per iteration would cost
more than the learning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    ClusteringEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.ml.top_items import best_by_product
from millrace.ml.topics import TopicLearner
from millrace.operators.charts import hash_below
from millrace.scratch import keep_pieces, spread

SEED = 7
#: Rows of a training frame that a task gets; learners hold up to 200 bytes for each of a few numbers.
PIECE = 500_000


# -- learners, with the parameters the jobs use ----------------------------


def linear_regression(label: str = "label", **changes) -> LinearRegression:
    given = {"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.8, **changes}
    return LinearRegression(featuresCol="features", labelCol=label, **given)


def logistic_regression(label: str = "label", **changes) -> LogisticRegression:
    given = {"maxIter": 10, "regParam": 0.9, "elasticNetParam": 0.6, **changes}
    return LogisticRegression(featuresCol="features", labelCol=label, **given)


def multinomial_regression(label: str = "label", **changes) -> LogisticRegression:
    given = {"regParam": 0.5, "elasticNetParam": 0.3, **changes}
    return logistic_regression(label, family="multinomial", **given)


def naive_bayes(label: str = "label") -> NaiveBayes:
    return NaiveBayes(smoothing=0.9, modelType="gaussian", labelCol=label)


def linear_svm(label: str = "label") -> LinearSVC:
    """Two classes only."""
    return LinearSVC(maxIter=10, regParam=0.1, labelCol=label)


def tree_regressor(label: str = "label") -> DecisionTreeRegressor:
    return DecisionTreeRegressor(labelCol=label, seed=SEED)


def tree_classifier(label: str = "label") -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, seed=SEED)


def forest_regressor(label: str = "label", trees: int = 5) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, numTrees=trees, seed=SEED)


def forest_classifier(label: str = "label", trees: int = 5) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, numTrees=trees, seed=SEED)


def boosted_regressor(label: str = "label", rounds: int = 5) -> GBTRegressor:
    return GBTRegressor(labelCol=label, maxIter=rounds, seed=SEED)


def boosted_classifier(label: str = "label", rounds: int = 5) -> GBTClassifier:
    """Two classes only."""
    return GBTClassifier(labelCol=label, maxIter=rounds, seed=SEED)


def k_means(k: int = 3) -> KMeans:
    return KMeans(k=k, seed=SEED)


def bisecting_k_means(k: int = 3) -> BisectingKMeans:
    return BisectingKMeans(k=k, seed=SEED)


def gaussian_mixture(k: int = 3, **changes) -> GaussianMixture:
    return GaussianMixture(k=k, seed=SEED, **changes)


def topics(k: int = 2, rounds: int = 1) -> TopicLearner:
    """Needs term counts (non-negative features)."""
    return TopicLearner(k, rounds, SEED)


def factors(user: str = "user_id", item: str = "item_id", rating: str = "rating") -> ALS:
    """Pairs without a trained factor drop out of the predictions."""
    return ALS(
        maxIter=3, regParam=0.03, userCol=user, itemCol=item, ratingCol=rating,
        coldStartStrategy="drop", seed=SEED,
    )


# -- data -----------------------------------------------------------------


def prepared(df: DataFrame, piece: int = PIECE) -> DataFrame:
    """Written once, in pieces of at most ``piece`` rows, a task each, and in enough of them to keep all
    cores busy in every iteration."""
    stored = keep_pieces(df, piece, "train")
    dealt = spread(stored)
    return stored if dealt is stored else keep_pieces(dealt, piece, "train")


def weighted(df: DataFrame, columns: Sequence[str], weight: str = "weight") -> DataFrame:
    """Each distinct row once, with how often it comes: the same to a learner with weights, and what an
    iteration costs grows with the distinct rows only."""
    return df.groupBy(*columns).agg(F.count("*").cast("double").alias(weight))


def moments(df: DataFrame, columns: Sequence[str], label: str = "label", weight: str = "weight") -> DataFrame:
    """At most two rows for all that are equal in ``columns`` (the features, a fold): their mean label, less and
    plus its deviation, with half of their number as weight each.  Number, sum and sum of squares of the
    labels stay, and squared errors and normal equations know nothing else, so linear regression with any
    penalty and its error come out the same.  A null label stays one."""
    y = F.col(label).cast("double")
    mean = F.when(F.count("*") == F.count(y), F.avg(y))
    groups = df.groupBy(*columns).agg(F.count("*").cast("double").alias("__n"), mean.alias("__mean"), F.stddev_pop(y).alias("__off"))

    def row(off: Column, share: float) -> Column:
        return F.struct((F.col("__mean") + off).alias(label), (F.col("__n") * share).alias(weight))

    off = F.col("__off")
    return groups.select(*columns, F.inline(F.when(off > 0, F.array(row(-off, 0.5), row(off, 0.5))).otherwise(F.array(row(F.lit(0.0), 1.0)))))


def fold_of(keys: Sequence[str], folds: int) -> Column:
    """A row's fold by the hash of a key."""
    return F.pmod(F.xxhash64(*keys), F.lit(folds)).cast("int")


def stable_split(
    df: DataFrame, keys: Sequence[str], fraction: float
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by the hash of a key.  Unlike a random split a row's side depends
    neither on the partitioning nor on the other rows."""
    inside = hash_below(keys, fraction)
    return df.where(inside), df.where(~inside)


def ratings(df: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """Integer triples; rows whose ids are not numbers drop out."""
    return df.select(
        F.col(user).try_cast("int").alias("user_id"),
        F.col(item).try_cast("int").alias("item_id"),
        F.col(rating).try_cast("int").alias("rating"),
    ).where("user_id IS NOT NULL AND item_id IS NOT NULL")


# -- metrics --------------------------------------------------------------


def regression_metrics(predicted: DataFrame, label: str = "label") -> dict[str, float]:
    """All from one pass: an evaluator makes the predictions anew for each metric."""
    # with a null on either side the metrics are no numbers
    error = F.coalesce(F.col(label).cast("double") - F.col("prediction"), F.lit(float("nan")))
    found = predicted.agg(
        F.sum(error * error).alias("squares"), F.avg(F.abs(error)).alias("mae"), F.count("*").alias("n"),
        F.var_pop(F.col(label).cast("double")).alias("variance")).first()
    if not found["n"]:
        raise ValueError("no predictions")
    squares, total = found["squares"], (found["variance"] or 0.0) * found["n"]
    r2 = 1 - squares / total if total else float("-inf" if squares > 0 else "nan")
    return {"rmse": (squares / found["n"]) ** 0.5, "mae": found["mae"], "r2": r2}


def class_metrics(predicted: DataFrame, label: str = "label") -> dict[str, float]:
    measure = MulticlassClassificationEvaluator(labelCol=label)
    return {
        m: measure.evaluate(predicted, {measure.metricName: m}) for m in ("accuracy", "f1")
    }


def ranking_metrics(predicted: DataFrame, score: str = "rawPrediction", label: str = "label",
                    bins: int = 0) -> dict[str, float]:
    """Area under the ROC curve, from all its points unless ``bins`` bounds them."""
    measure = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=bins
    )
    return {"auc": measure.evaluate(predicted)}


def silhouette(predicted: DataFrame) -> dict[str, float]:
    return {"silhouette": ClusteringEvaluator().evaluate(predicted)}


def metric_rows(spark: SparkSession, metrics: Mapping[str, float]) -> DataFrame:
    rows = [(k, float(v)) for k, v in metrics.items()]
    return spark.createDataFrame(rows, "metric string, value double")


def text_rows(spark: SparkSession, model) -> DataFrame:
    """A tree model as text: rows (line, text)."""
    return spark.createDataFrame(list(enumerate(model.toDebugString.splitlines())), "line int, text string")


# -- search ---------------------------------------------------------------


def grid_search(
    learner: Estimator, evaluator, train: DataFrame, grid: Mapping[str, Sequence],
    folds: int = 2, parallelism: int = 4, fold: str = "",
) -> tuple[Model, DataFrame]:
    """Best model, and one row per setting with its mean metric over the folds, which are random or
    numbers in the column ``fold``."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(learner.getParam(name), list(values))
    settings = builder.build()
    search = CrossValidator(
        estimator=learner, estimatorParamMaps=settings, evaluator=evaluator, numFolds=folds,
        parallelism=parallelism, seed=SEED, foldCol=fold,
    ).fit(train)
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(s.items(), key=lambda e: e[0].name)), float(m))
        for s, m in zip(settings, search.avgMetrics)
    ]
    table = train.sparkSession.createDataFrame(rows, "setting string, metric double")
    return search.bestModel, table


def regression_evaluator(label: str = "label", **changes) -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, metricName="rmse", **changes)


def class_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")


# -- recommendations ------------------------------------------------------


def _factors(frame: DataFrame) -> DataFrame:
    return frame.select("id", F.col("features").alias("vector"))


def top_items(model: ALSModel, n: int = 5, **blocks: int) -> DataFrame:
    """Rows (user_id, rank, item_id, rating, blocks): the best ``n`` items of every user, and how many blocks
    of items it took to know them."""
    best = best_by_product(_factors(model.userFactors), _factors(model.itemFactors), n, **blocks)
    return best.select(F.col("user").cast("int").alias("user_id"), "rank", F.col("item").cast("int").alias("item_id"), F.col("score").alias("rating"), "blocks")


def top_users(model: ALSModel, n: int = 5, **blocks: int) -> DataFrame:
    """Rows (item_id, rank, user_id, rating, blocks): the best ``n`` users of every item."""
    best = best_by_product(_factors(model.itemFactors), _factors(model.userFactors), n, **blocks)
    return best.select(F.col("user").cast("int").alias("item_id"), "rank", F.col("item").cast("int").alias("user_id"), F.col("score").alias("rating"), "blocks")

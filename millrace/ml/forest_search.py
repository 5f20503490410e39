"""Search over a large grid of forest settings: many small models at once, few large ones.

The settings are rows of a table.  On each rung every (setting, fold) is fitted in a task of its
own, on a sample whose size is a parameter, so one job tries the whole grid; settings that differ
only in their number of trees share a fit, as the first trees of a forest are a smaller forest.
The best share of the settings goes on to the next rung, with a larger sample.  The few left at the end
are fitted and scored by the learning library on all rows, over the same folds; the best
of them is the result.  Equal rows go to it once, with their weight, where a setting cannot tell.

What a task gets is one rung's sample: ``rows`` times the number of features, whatever the size of
the table.  The forests of the rungs only rank settings; no score of theirs is a result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.ml.models import SEED, fold_of, prepared, weighted
from millrace.scratch import keep

#: The grid's parameters by the learner's names.  Fixed values: the job's grid, as far as the learner
#: has the parameter (it has no least number of rows for a split); no bound on depth is its largest one.
GRID = {
    "maxDepth": [2, 30],
    "featureSubsetStrategy": ["1", "2", "5"],
    "minInstancesPerNode": [1, 2, 5],
    "bootstrap": [True, False],
    "impurity": ["gini", "entropy"],
    "numTrees": [5, 10, 15, 20],
}
BINS = 32
_FOLD = "__fold"
_TASK = "number int, fold int, trees array<int>, depth int, features int, least int, bootstrap boolean, impurity string"


@dataclass
class Search:
    best: Model
    #: setting, rung, rows, metric; the last rung's metrics are the library's over all rows.
    tried: DataFrame


def binned(x: np.ndarray) -> np.ndarray:
    """Columns as numbers of at most ``BINS`` quantile bins."""
    out = np.empty(x.shape, np.int64)
    for j in range(x.shape[1]):
        edges = np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
        out[:, j] = np.searchsorted(edges, x[:, j], "left")
    return out


def _impurity(counts: np.ndarray, kind: str) -> np.ndarray:
    """Of class counts along the last axis, times their sum."""
    total = counts.sum(axis=-1, keepdims=True)
    share = counts / np.maximum(total, 1e-300)
    if kind == "gini":
        one = 1 - (share * share).sum(axis=-1)
    else:
        one = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=-1)
    return one * total[..., 0]


def grown(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, classes: int, depth: int, features: int, least: int, impurity: str,
          rng: np.random.Generator, test: np.ndarray) -> np.ndarray:
    """Class shares that a tree gives each row of ``test``; it grows level by level, all nodes of a
    level at once, from the counts by (node, feature, bin, class)."""
    d, width = bins.shape[1], int(bins.max(initial=0)) + 1
    node, at = np.zeros(len(y), np.int64), np.zeros(len(test), np.int64)
    shares = np.zeros((len(test), classes))
    active, rows, tested = 1, np.arange(len(y)), np.arange(len(test))
    for level in range(depth + 1):
        counts = np.stack([
            np.bincount((node[rows] * width + bins[rows, j]) * classes + y[rows], weight[rows], active * width * classes)
            .reshape(active, width, classes) for j in range(d)], axis=1)
        total = counts[:, 0].sum(axis=1)
        mean = total / np.maximum(total.sum(axis=1, keepdims=True), 1e-300)
        shares[tested] = mean[at[tested]]
        if level == depth:
            break
        left = np.cumsum(counts, axis=2)[:, :, :-1]
        right = total[:, None, None] - left
        gain = _impurity(total, impurity)[:, None, None] - _impurity(left, impurity) - _impurity(right, impurity)
        gain[(left.sum(axis=-1) < least) | (right.sum(axis=-1) < least)] = -1
        if features < d:    # each node looks at some of the features
            gain[np.argsort(rng.random((active, d)), axis=1) >= features] = -1
        if gain.shape[2] == 0:
            break
        best = gain.reshape(active, -1).argmax(axis=1)
        splits = gain.reshape(active, -1)[np.arange(active), best] > 1e-9
        if not splits.any():
            break
        feature, cut = best // gain.shape[2], best % gain.shape[2]
        child = np.where(splits, 2 * (np.cumsum(splits) - 1), -1)

        def descend(which: np.ndarray, place: np.ndarray, of: np.ndarray) -> np.ndarray:
            which = which[splits[place[which]]]
            n = place[which]
            place[which] = child[n] + (of[which, feature[n]] > cut[n])
            return which

        rows, tested = descend(rows, node, bins), descend(tested, at, test)
        active = 2 * int(splits.sum())
    return shares


def scores(bins: np.ndarray, y: np.ndarray, fold: np.ndarray, task: Mapping) -> list[float]:
    """Share of right answers on a fold, of the forest's first trees for each asked number of them."""
    test, classes = fold == task["fold"], int(y.max(initial=0)) + 1
    if not test.any() or test.all():
        return [0.0] * len(task["trees"])
    x, own, rng = bins[~test], y[~test], np.random.default_rng([SEED, task["fold"]])
    votes, out = np.zeros((int(test.sum()), classes)), {}
    for i in range(1, max(task["trees"]) + 1):
        weight = rng.poisson(1.0, len(own)).astype(float) if task["bootstrap"] else np.ones(len(own))
        votes += grown(x, own, weight, classes, task["depth"], task["features"], task["least"], task["impurity"], rng, bins[test])
        out[i] = float((votes.argmax(axis=1) == y[test]).mean())
    return [out[n] for n in task["trees"]]


def settings_of(grid: Mapping[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def named(setting: Mapping) -> str:
    return ", ".join(f"{k}={v}" for k, v in sorted(setting.items()))


def _rung(train: DataFrame, settings: list[dict], features: str, label: str, folds: int, share: float) -> list[float]:
    """Mean score over the folds of each setting, on a sample by the rows' hash."""
    spark = train.sparkSession
    sample = train.where(F.col("__u") < share).select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"), _FOLD).toPandas()
    if not len(sample):
        return [0.0] * len(settings)
    sample = sample.sort_values([_FOLD, "y"], kind="stable")
    held = spark.sparkContext.broadcast((binned(np.stack(sample["x"].to_numpy())), sample["y"].to_numpy(), sample[_FOLD].to_numpy()))
    alike: dict[tuple, list[int]] = {}
    for i, s in enumerate(settings):
        alike.setdefault(tuple((k, v) for k, v in s.items() if k != "numTrees"), []).append(i)
    groups = list(alike.values())
    tasks = [(g, f, [settings[i]["numTrees"] for i in of], s["maxDepth"], int(s["featureSubsetStrategy"]), s["minInstancesPerNode"],
              s["bootstrap"], s["impurity"]) for g, of in enumerate(groups) for s in [settings[of[0]]] for f in range(folds)]

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"number": batch["number"], "metrics": [scores(*held.value, t) for t in batch.to_dict("records")]})

    parts = min(len(tasks), 4 * spark.sparkContext.defaultParallelism)
    table = spark.createDataFrame(tasks, _TASK).repartition(parts, "number", "fold")
    total = np.zeros(len(settings))
    for r in table.mapInPandas(fit, "number int, metrics array<double>").collect():
        total[groups[r["number"]]] += r["metrics"]
    held.destroy()
    return (total / folds).tolist()


def by_weight(setting: Mapping) -> bool:
    """Whether a forest sees rows through nothing but their weights: neither draws them nor counts them."""
    return not setting.get("bootstrap", True) and setting.get("minInstancesPerNode", 1) == 1


def _validated(data: DataFrame, few: DataFrame, learners: list[RandomForestClassifier], label: str, folds: int, parallelism: int) -> list[float]:
    """Mean share of right answers over the folds of each learner's forests.  Folds are conditions on a column, so
    training reads the stored rows as they are, and a fold is read once for the forests of all learners."""
    total = np.zeros(len(learners))
    with ThreadPool(min(parallelism, len(learners))) as pool:
        for i in range(folds):
            fit = inheritable_thread_target(data.sparkSession)(
                lambda own: own.copy({own.rawPredictionCol: "", own.probabilityCol: ""}).fit(_rows_for(own, data, few).where(F.col(_FOLD) != i)))
            found, test = pool.map(fit, learners), few.where(F.col(_FOLD) == i)
            for j, model in enumerate(found):
                test = model.setPredictionCol(f"__p{j}").transform(test)
            weight = F.sum("weight")
            right = test.agg(*[F.sum(F.when(F.col(f"__p{j}") == F.col(label), F.col("weight")).otherwise(0.0)) / weight for j in range(len(found))]).first()
            total += [float("nan") if r is None else r for r in right]
    return (total / folds).tolist()


def _rows_for(learner: RandomForestClassifier, data: DataFrame, few: DataFrame) -> DataFrame:
    return few if learner.isSet(learner.weightCol) else data


def halving_search(
    train: DataFrame, keys: Sequence[str], grid: Mapping[str, Sequence] = GRID, features: str = "features", label: str = "label",
    folds: int = 3, rows: int = 1000, growth: int = 3, finalists: int = 2, parallelism: int = 4,
) -> Search:
    """The best forest of a grid.  A row's fold and its place in the samples come from a hash of
    ``keys``, so they depend neither on the partitioning nor on the other rows.

    Each rung keeps one of ``growth`` settings (equal scores: those earlier in the grid) and its sample is
    ``growth`` times larger, beginning with about ``rows`` rows.  ``train`` should be stored.

    Finalists that see rows only by weight are fitted to the distinct rows with their weights, others to all rows.
    """
    spark = train.sparkSession
    hashed = F.xxhash64(*keys)
    data = train.select(features, label, fold_of(keys, folds).alias(_FOLD),
                        (F.pmod(F.xxhash64(hashed), F.lit(1 << 30)) / float(1 << 30)).alias("__u"))
    n, top = data.agg(F.count("*"), F.max(label)).first()
    # the learner need not look for the number of classes at each fit
    about = {"ml_attr": {"type": "nominal", "name": label, "num_vals": int(top or 0) + 1}}

    def classed(df: DataFrame) -> DataFrame:
        return df.withColumn(label, F.col(label).cast("double").alias(label, metadata=about))

    data = classed(data)
    left, tried, rung, size = settings_of(grid), [], 0, rows
    largest, some = rows, len(left)
    while some > finalists:
        largest, some = largest * growth, max(finalists, some // growth)
    # a sample holds the smaller ones
    sampled = keep(data.where(F.col("__u") < min(1.0, largest / growth / max(n, 1))), "samples") if len(left) > finalists else data
    while len(left) > finalists:
        metrics = _rung(sampled, left, features, label, folds, min(1.0, size / max(n, 1)))
        tried += [(named(s), rung, min(size, n), m) for s, m in zip(left, metrics)]
        order = sorted(range(len(left)), key=lambda i: (-metrics[i], i))
        left = [left[i] for i in order[:max(finalists, len(left) // growth)]]
        rung, size = rung + 1, size * growth
    learners = [RandomForestClassifier(featuresCol=features, labelCol=label, seed=SEED) for _ in left]
    for learner, setting in zip(learners, left):
        learner._set(**setting, **({"weightCol": "weight"} if by_weight(setting) else {}))
    if any(map(by_weight, left)):
        few = classed(prepared(weighted(data, [_FOLD, features, label])))
    else:
        few = data.withColumn("weight", F.lit(1.0))
    metrics = _validated(data, few, learners, label, folds, parallelism)
    best = learners[int(np.nanargmax(metrics))]
    tried += [(named(s), rung, n, float(m)) for s, m in zip(left, metrics)]
    return Search(best.fit(_rows_for(best, data, few)), spark.createDataFrame(tried, "setting string, rung int, rows long, metric double"))

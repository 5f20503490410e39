"""Topic models over a vocabulary of any size.

Online variational Bayes (Hoffman, Blei and Bach, 2010) with the steps, settings, starting values and stopping
rule of the library's online LDA.  The library holds a number for each term and topic several times on the
driver and once in each task; here they are a stored table (idx, weights).  The most frequent terms, which make
up nearly all text, are sent to the tasks as an array of ``SENT`` numbers at most; the others are joined to the
documents that have them.

Documents have a column that tells rows apart, and features as ``features.TermCounter`` gives them: rising
indices of terms and their counts.  A document without a known term has the mix 0, 0, ..., as in the library.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from millrace.ml.features import list_column, slices
from millrace.scratch import keep

#: Numbers that every task gets; terms whose numbers are not among them are joined.
SENT = 1 << 19
#: Terms whose starting weights are drawn together.
DRAW = 1 << 16
#: Of the gamma distribution that weights and mixes start from.
SHAPE = 100.0
#: A mix is found when its parameters move by no more, on average.
STILL = 1e-3
#: Rows of the statistics that belong to no term: sums of E[log theta], number of documents.
_MIXES, _DOCS = -1, -2


# -- functions ------------------------------------------------------------


def digamma(x: np.ndarray) -> np.ndarray:
    x, low = np.asarray(x, float), 0.0
    for _ in range(6):
        low, x = low + 1 / x, x + 1
    i = 1 / (x * x)
    return np.log(x) - 0.5 / x - i * (1 / 12 - i * (1 / 120 - i * (1 / 252 - i * (1 / 240 - i / 132)))) - low


def trigamma(x: np.ndarray) -> np.ndarray:
    x, low = np.asarray(x, float), 0.0
    for _ in range(6):
        low, x = low + 1 / (x * x), x + 1
    i = 1 / (x * x)
    return (1 + (0.5 + (1 / 6 - i * (1 / 30 - i * (1 / 42 - i / 30))) / x) / x) / x + low


def expected_log(x: np.ndarray, axis: int = -1) -> np.ndarray:
    """E[log p] of Dirichlet distributions, one a row, or one a column for axis 0."""
    return digamma(x) - digamma(x.sum(axis=axis, keepdims=True))


def inferred(counts: np.ndarray, weights: np.ndarray, sizes: np.ndarray, alpha: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Parameters of the mixes of documents that have ``sizes`` terms each, none of them 0.  ``weights`` has
    exp(E[log beta]) of each document's terms.  Each document stops by itself."""
    gamma, weights, alpha = np.tile(start[:, None], len(sizes)), np.ascontiguousarray(weights.T), alpha[:, None]
    live, now, going = np.arange(len(sizes)), gamma.copy(), np.ones(len(sizes), bool)
    while live.size:
        begins = np.cumsum(sizes) - sizes
        while (left := going.sum()) and left > 0.7 * len(going):    # fewer: the others are taken out
            theta = np.exp(expected_log(now, 0))
            norm = sum(w * np.repeat(t, sizes) for w, t in zip(weights, theta)) + 1e-100
            share = counts / norm
            new = theta * np.stack([np.add.reduceat(w * share, begins) for w in weights]) + alpha
            moved = np.abs(new - now).mean(axis=0)
            now[:, going] = new[:, going]
            going &= moved > STILL
        gamma[:, live] = now
        pairs = np.repeat(going, sizes)
        counts, weights = counts[pairs], weights[:, pairs]
        live, now, sizes, going = live[going], now[:, going], sizes[going], going[going]
    return gamma.T


# -- model and learner ----------------------------------------------------


class TopicModel:
    """Weights of terms as a table, one number a topic, and the parameters of the documents' mixes."""

    def __init__(self, weights: DataFrame, size: int, alpha: np.ndarray, seed: int, row: str):
        self.weights, self.size, self.alpha, self.seed, self.row = weights, size, alpha, seed, row
        self.k = len(alpha)
        self.totals = np.array(weights.agg(*[F.coalesce(F.sum(F.col("weights")[t]), F.lit(1.0)) for t in range(self.k)]).first())

    def describeTopics(self, most: int = 10) -> DataFrame:
        """Rows (topic, termIndices, termWeights): the heaviest terms of each topic, the heaviest first."""
        spark, found = self.weights.sparkSession, None
        for t in range(self.k):
            share = F.col("weights")[t] / F.lit(float(self.totals[t]))
            top = self.weights.select(F.lit(t).alias("topic"), "idx", share.alias("share")).orderBy(F.desc("share"), "idx").limit(most)
            found = top if found is None else found.union(top)
        best = found.groupBy("topic").agg(F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("less"), "idx"))).alias("terms"))
        terms = F.coalesce("terms", F.array().cast("array<struct<less:double,idx:bigint>>"))
        return spark.range(self.k).select(F.col("id").cast("int").alias("topic")).join(best, "topic", "left").select(
            "topic", terms["idx"].alias("termIndices"), F.transform(terms["less"], lambda x: -x).alias("termWeights")).orderBy("topic")

    def transform(self, docs: DataFrame) -> DataFrame:
        """``topicDistribution`` instead of the features."""
        others = [c for c in docs.columns if c != "features"]
        schema = StructType([*docs.select(*others).schema.fields, StructField("topicDistribution", ArrayType(DoubleType()))])
        infer = self._infer()

        def mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, _, _, _, full, gamma in infer(batches):
                mix = np.zeros((part.num_rows, gamma.shape[1]))
                mix[full] = gamma / gamma.sum(axis=1, keepdims=True)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), _vectors(mix)], names=[*others, "topicDistribution"])

        return self._with_weights(docs).mapInArrow(mixed, schema)

    def statistics(self, docs: DataFrame, times: str) -> DataFrame:
        """Rows (idx, stats): the expected uses of each term in each topic, where a document counts as often as
        ``times`` says, and the rows ``_MIXES`` and ``_DOCS``."""
        infer, k = self._infer(), self.k

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, idx, counts, weights, full, gamma in infer(batches):
                if not full.any():
                    continue
                n = part.column(times).to_numpy()[full].astype(float)
                sizes = np.diff(part.column("__indices").offsets.to_numpy())[full]
                logs = expected_log(gamma)
                theta = np.repeat(np.exp(logs), sizes, axis=0)
                norm = np.einsum("pk,pk->p", weights, theta) + 1e-100
                uses = weights * theta * (counts / norm * np.repeat(n, sizes))[:, None]
                terms, at = np.unique(idx, return_inverse=True)
                stats = np.stack([np.bincount(at, uses[:, t]) for t in range(k)], axis=1)
                stats = np.concatenate([stats, [n @ logs], [np.full(k, n.sum())]])
                yield pa.record_batch({"idx": np.r_[terms.astype(np.int64), _MIXES, _DOCS], "stats": _vectors(stats)})

        found = self._with_weights(docs).mapInArrow(counted, "idx long, stats array<double>")
        return found.groupBy("idx").agg(F.array(*[F.sum(F.col("stats")[t]) for t in range(k)]).alias("stats"))

    def _head(self) -> int:
        """Terms whose weights are sent."""
        return min(self.size, SENT // self.k)

    def _with_weights(self, docs: DataFrame) -> DataFrame:
        """Indices and counts as columns of their own, and the weights of the terms that are not sent, in the
        order of the indices."""
        flat = docs.select(*[c for c in docs.columns if c != "features"],
                           F.col("features.indices").alias("__indices"), F.col("features.values").alias("__values"))
        head = self._head()
        if self.size <= head:
            return flat.withColumn("__more", F.array().cast("array<double>"))
        rare = flat.select(self.row, F.explode(F.filter(F.col("__indices").cast("array<long>"), lambda i: i >= head)).alias("idx"))
        pairs = rare.join(self.weights.where(F.col("idx") >= head), "idx").groupBy(self.row).agg(
            F.array_sort(F.collect_list(F.struct("idx", "weights"))).alias("__more"))
        return flat.join(pairs.select(self.row, F.flatten(F.col("__more.weights")).alias("__more")), self.row, "left")

    def _infer(self):
        """A function over batches of ``_with_weights``: gives for each slice of rows itself, the index, count and
        exp(E[log beta]) of each of its terms, which rows have terms, and the parameters of their mixes."""
        head, k, alpha, bottom = self._head(), self.k, self.alpha, digamma(self.totals)
        sent = self.weights.where(F.col("idx") < head).orderBy("idx").select("weights").toArrow().column(0).combine_chunks()
        sent = np.exp(digamma(sent.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)) - bottom)
        start = np.random.default_rng(self.seed).gamma(SHAPE, 1 / SHAPE, k)

        def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for batch in batches:
                for part in slices(batch, "__indices"):
                    lists = part.column("__indices")
                    sizes = np.diff(lists.offsets.to_numpy())
                    idx = lists.flatten().to_numpy(zero_copy_only=False)
                    counts = part.column("__values").flatten().to_numpy(zero_copy_only=False).astype(float)
                    weights, rare = np.empty((len(idx), k)), idx >= head
                    weights[~rare] = sent[idx[~rare]]
                    more = part.column("__more").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
                    weights[rare] = np.exp(digamma(more) - bottom)
                    full = sizes > 0
                    yield part, idx, counts, weights, full, inferred(counts, weights, sizes[full], alpha, start)

        return infer


class TopicLearner:
    """``rounds`` steps of online variational Bayes, each on a random ``share`` of the documents; the
    prior of the mixes is learnt, that of the topics stays.  Needs term counts."""

    def __init__(self, k: int = 2, rounds: int = 20, seed: int = 7, row: str = "row",
                 share: float = 0.05, offset: float = 1024.0, decay: float = 0.51):
        self.k, self.rounds, self.seed, self.row = k, rounds, seed, row
        self.share, self.offset, self.decay = share, offset, decay

    def fit(self, docs: DataFrame) -> TopicModel:
        first = docs.select("features.size").first()
        if first is None:
            raise ValueError("no documents")
        size, number = first["size"], docs.count()
        alpha = np.full(self.k, 1 / self.k)
        model = TopicModel(self._start(docs.sparkSession, size), size, alpha, self.seed, self.row)
        for step in range(1, self.rounds + 1):
            model = self._step(model, docs, number, step)
        return model

    def _start(self, spark: SparkSession, size: int) -> DataFrame:
        k, seed = self.k, self.seed

        def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b in batch.column(0).to_pylist():
                    idx = np.arange(b * DRAW, min(size, (b + 1) * DRAW))
                    yield pa.record_batch({"idx": idx, "weights": _vectors(np.random.default_rng([seed, b]).gamma(SHAPE, 1 / SHAPE, (len(idx), k)))})

        return keep(spark.range(-(-size // DRAW)).mapInArrow(drawn, "idx long, weights array<double>"), "topics")

    def _times(self, step: int) -> Column:
        """How often a document is drawn, with replacement, by the hash of its row."""
        at = F.shiftrightunsigned(F.xxhash64(F.lit(self.seed), F.lit(step), F.col(self.row)), 11) / F.lit(2.0**53)
        chances = [math.exp(-self.share) * self.share**n / math.factorial(n) for n in range(12)]
        return sum(((at >= float(b)).cast("int") for b in np.cumsum(chances)), F.lit(0))

    def _step(self, model: TopicModel, docs: DataFrame, number: int, step: int) -> TopicModel:
        drawn = docs.select(self.row, "features", self._times(step).alias("__times")).where("__times > 0")
        stats = keep(model.statistics(drawn, "__times"), "topics")
        own = {r["idx"]: np.array(r["stats"]) for r in stats.where("idx < 0").toArrow().to_pylist()}
        if _DOCS not in own:
            return model    # nothing drawn
        rate, scale = (self.offset + step) ** -self.decay, number / math.ceil(self.share * number)
        new = [F.col("weights")[t] * (1 - rate) + (F.coalesce(F.col("stats")[t], F.lit(0.0)) * scale + 1 / self.k) * rate
               for t in range(self.k)]
        weights = keep(model.weights.join(stats, "idx", "left").select("idx", F.array(*new).alias("weights")), "topics")
        seen = own[_DOCS][0]
        return TopicModel(weights, model.size, self._prior(model.alpha, own[_MIXES] / seen, seen, rate), self.seed, self.row)

    def _prior(self, alpha: np.ndarray, logs: np.ndarray, seen: float, rate: float) -> np.ndarray:
        """A Newton step for the prior of the mixes; not taken if it leaves the domain."""
        gradient = seen * (logs - expected_log(alpha))
        c, q = seen * trigamma(alpha.sum()), -seen * trigamma(alpha)
        b = (gradient / q).sum() / (1 / c + (1 / q).sum())
        new = alpha - rate * (gradient - b) / q
        return new if (new > 0).all() else alpha


def _vectors(values: np.ndarray) -> pa.ListArray:
    """A list for each row of a matrix."""
    return list_column(np.full(len(values), values.shape[1]), pa.array(values.ravel()))

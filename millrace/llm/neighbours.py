"""Approximate nearest neighbours by cosine: stable projections to few dimensions, indexed by
kd-trees.

Vectors are scaled to length one, so the largest cosine is the least distance, and projected
by ``DIMENSIONS`` Gaussian (2-stable) directions: the squared projected distance over the
squared true one follows a chi-square law with as many degrees of freedom.  A query takes the
boxes of a tree in the order of their projected distance and verifies the vectors in them.  It
stops once a vector as near as its k-th best would, with probability ``CONFIDENCE``, have been
projected nearer than the next box.

Two levels.  A tree over the projections of a bounded sample (``SAMPLE`` rows) cuts the projected
space into cells; every row lies in one.  In a first round a query searches its own
cell, which gives it a k-th best; in the second it goes only to the cells whose box (of
all rows in it) passes the stopping test.  A cell's rows are dealt out into shards of
about ``SHARD_ROWS`` with a tree each; queries for a cell come in blocks, so a task's row is one
shard and one block, and the queries of a block take their boxes together, in growing steps.
How many cells a query meets depends on the data: clusters are told apart, but of vectors without any
structure most are within the test's reach of each other.

Of vectors that are equal in all components only the smallest ids can be among the nearest, so a
shard indexes them as one; nothing is lost.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows
with a null id.  Only vectors of one length are compared.  Equal scores go to the smaller id.
Rows that repeat an id are one candidate, or one query, with the best score of any of them; an
id is never a candidate for itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.scratch import keep

DIMENSIONS = 8
CONFIDENCE = 0.97
SHARD_ROWS = 4096
BLOCK_ROWS = 4096
#: Rows whose projections fit the tree of cells, about, and the cells that it has at most.
SAMPLE = 1 << 16
CELLS = 1 << 11
LEAF = 64
SEED = 20
#: By how much a product of matrices may miss a cosine that is then computed exactly.
ROUNDING = 1e-9


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x.cast("double") != 0)


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total if x < 1400 else 1.0


def stopping_factor(confidence: float, freedom: int) -> float:
    """The x at which the distribution function reaches the confidence."""
    low, high = 0.0, 1400.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, freedom) < confidence else (low, mid)
    return high


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that their largest components are near one: no
    square overflows, no bit of a component or of a cosine changes."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one."""
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def directions(width: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((width, dimensions))


class KDTree:
    """Leaves of at most ``leaf`` points, cut at the median of the widest dimension.  ``order`` has the
    points leaf by leaf, ``ends`` where each leaf ends, ``low`` and ``high`` the box of its points."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.cuts: list[tuple[int, float, int, int]] = []       # dimension, value, nodes below (leaves as -1 - leaf)
        self.ends: list[int] = []
        self.top = self._build(points, 0, len(points), leaf)
        starts = [0, *self.ends[:-1]]
        self.low = np.array([points[self.order[a:b]].min(axis=0) for a, b in zip(starts, self.ends)])
        self.high = np.array([points[self.order[a:b]].max(axis=0) for a, b in zip(starts, self.ends)])

    def _build(self, points: np.ndarray, start: int, end: int, leaf: int) -> int:
        own = points[self.order[start:end]]
        spread = own.max(axis=0) - own.min(axis=0)
        axis = int(np.argmax(spread))
        if end - start > leaf and spread[axis] > 0:
            along = own[:, axis]
            value = float(np.partition(along, (end - start) // 2)[(end - start) // 2])
            if value == along.min():    # half of the points share the least value
                value = float(along[along > value].min())
            below = along < value
            middle, at = start + int(below.sum()), len(self.cuts)
            self.order[start:end] = np.r_[self.order[start:end][below], self.order[start:end][~below]]
            self.cuts.append((axis, value, 0, 0))
            self.cuts[at] = (axis, value, self._build(points, start, middle, leaf), self._build(points, middle, end, leaf))
            return at
        self.ends.append(end)
        return -len(self.ends)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf in whose part of the space each point lies."""
        out, todo = np.zeros(len(points), np.int64), [(self.top, np.arange(len(points)))]
        while todo:
            at, which = todo.pop()
            if at < 0:
                out[which] = -1 - at
                continue
            axis, value, left, right = self.cuts[at]
            below = points[which, axis] < value
            todo += [(left, which[below]), (right, which[~below])]
        return out


def box_distances(low: np.ndarray, high: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distance of each point (a row) to each box (a column)."""
    out = np.zeros((len(points), len(low)))
    for j in range(points.shape[1]):
        gap = np.maximum(np.maximum(low[:, j] - points[:, j, None], points[:, j, None] - high[:, j]), 0)
        out += gap * gap
    return out


def reach(score: np.ndarray | float, factor: float) -> np.ndarray | float:
    """Up to which squared projected distance a better vector than one of this cosine may lie:
    the squared distance of unit vectors is two less twice the cosine."""
    return factor * np.maximum(0.0, 2 - 2 * score)


def search(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
           dimensions: int = DIMENSIONS, confidence: float = CONFIDENCE, floors: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(place of the query, id, cosine) of the k best ids of each query among the rows that it
    verified; only ids with at least the query's floor, if floors are given."""
    if not len(rows) or not len(query_ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    # equal rows: the k + 1 smallest ids stand for all, as one may be the query's own
    raw = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * 8))).ravel()
    _, of = np.unique(raw, return_inverse=True)
    order = np.lexsort((ids, of))
    ids, rows, of = ids[order], rows[order], of[order]
    repeated = np.r_[False, (np.diff(of) == 0) & (np.diff(ids) == 0)]
    ids, rows, of = ids[~repeated], rows[~repeated], of[~repeated]
    new = np.flatnonzero(np.r_[True, np.diff(of) != 0])
    few = np.arange(len(of)) - np.repeat(new, np.diff(np.r_[new, len(of)])) <= k
    ids, rows, of, queries = ids[few], scaled(rows[few]), of[few], scaled(queries)
    starts = np.flatnonzero(np.r_[True, np.diff(of) != 0])
    sizes = np.diff(np.r_[starts, len(of)])
    distinct = rows[starts]
    axes = directions(rows.shape[1], dimensions)
    near, asked = unit(distinct), unit(queries)
    tree = KDTree(near @ axes)
    begins = np.array([0, *tree.ends[:-1]])
    far = box_distances(tree.low, tree.high, asked @ axes)
    turn = np.argsort(far, axis=1, kind="stable")
    factor = stopping_factor(confidence, dimensions)
    q = len(query_ids)
    # the best so far: k of each query, a floor below which nothing counts
    best_id, best = np.full((q, k), -1, np.int64), np.full((q, k), -np.inf)
    least = np.full(q, -np.inf) if floors is None else floors.astype(float)
    done, step = 0, 1
    while done < len(begins):
        leaves = turn[:, done:done + step]
        bound = np.where(np.isfinite(least), reach(np.where(np.isfinite(least), least, 0), factor), np.inf)
        wanted = np.take_along_axis(far, leaves, axis=1) < bound[:, None]
        if not wanted.any():
            break
        which, leaf = np.nonzero(wanted)[0], leaves[wanted]
        sort = np.argsort(leaf, kind="stable")
        which, leaf = which[sort], leaf[sort]
        found_q, found_p = [], []
        edges = np.flatnonzero(np.r_[True, np.diff(leaf) != 0, True])
        for a, b in zip(edges, edges[1:]):
            points = tree.order[begins[leaf[a]]:tree.ends[leaf[a]]]
            some = which[a:b]
            i, j = np.nonzero(asked[some] @ near[points].T >= (least[some] - ROUNDING)[:, None])
            found_q.append(some[i])
            found_p.append(points[j])
        at, p = np.concatenate(found_q), np.concatenate(found_p)
        # all ids of a distinct row, with the cosine in double precision
        score = cosines_of(distinct, p, queries, at)
        n = sizes[p]
        at, score = np.repeat(at, n), np.repeat(score, n)
        p = np.repeat(starts[p], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        own = ids[p]
        good = (own != query_ids[at]) & (score >= least[at])
        at, own, score = at[good], own[good], score[good]
        touched = np.unique(at)
        held = np.repeat(touched, k)
        best_at, best_own, best_score = best_of(np.r_[held, at], np.r_[best_id[touched].ravel(), own], np.r_[best[touched].ravel(), score], k)
        place = np.arange(len(best_at)) - np.repeat(*_runs(best_at))
        best[touched], best_id[touched] = -np.inf, -1
        best_id[best_at, place], best[best_at, place] = best_own, best_score
        least = np.maximum(least, best[:, -1])
        done, step = done + step, step * 2
    at, place = np.nonzero(np.isfinite(best))
    return at, best_id[at, place], best[at, place]


def _runs(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins, and its length."""
    starts = np.flatnonzero(np.r_[True, np.diff(sorted_) != 0]) if len(sorted_) else np.zeros(0, np.int64)
    return starts, np.diff(np.r_[starts, len(sorted_)])


def cosines_of(rows: np.ndarray, i: np.ndarray, queries: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of pairs of a row and a query, some thousand at a time."""
    out = np.empty(len(i))
    for a in range(0, len(i), 8192):
        x, y = rows[i[a:a + 8192]], queries[j[a:a + 8192]]
        out[a:a + 8192] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
    return out


def best_of(at: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k ids of largest score for each place, falling, ties to the smaller id; an id counts once."""
    order = np.lexsort((-score, ids, at))
    at, ids, score = at[order], ids[order], score[order]
    once = np.r_[True, (np.diff(at) != 0) | (np.diff(ids) != 0)] if len(at) else np.zeros(0, bool)
    at, ids, score = at[once], ids[once], score[once]
    order = np.lexsort((ids, -score, at))
    at, ids, score = at[order], ids[order], score[order]
    good = np.isfinite(score)
    at, ids, score = at[good], ids[good], score[good]
    few = np.arange(len(at)) - np.repeat(*_runs(at)) < k
    return at[few], ids[few], score[few]


def projected(df: DataFrame, dimensions: int) -> DataFrame:
    """``df`` (id, vector) with ``p``, the projection of the vector at length one."""
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1).to_numpy(zero_copy_only=False)
            out = np.empty((len(vectors), dimensions))
            widths = np.array([len(v) for v in vectors])
            for w in np.unique(widths):
                out[widths == w] = unit(scaled(np.stack(vectors[widths == w]))) @ directions(int(w), dimensions)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(out), pa.list_(pa.float64()))], names=["id", "vector", "p"])

    return df.mapInArrow(project, "id long, vector array<double>, p array<double>")


def _tree(rows: DataFrame, n: int) -> KDTree:
    """Of the projections of a sample by hash, whose size is bounded, with cells of ``SHARD_ROWS`` rows while
    there are not too many."""
    share = min(1.0, SAMPLE / max(n, 1))
    chosen = F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    points = np.array([r["p"] for r in rows.where(chosen).select("p").orderBy("p").toLocalIterator()])
    cells = min(CELLS, n // SHARD_ROWS + 1)
    return KDTree(points, max(1, -(-len(points) // cells)))


def _in_cells(df: DataFrame, tree: KDTree) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.leaf_of(p))], names=["id", "vector", "p", "salt", "cell"])

    return df.mapInArrow(place, "id long, vector array<double>, p array<double>, salt long, cell long").withColumn("dim", F.size("vector"))


def _packed(df: DataFrame, size: int, names: tuple[str, str, str]) -> DataFrame:
    """(dim, cell, part, parts, and under ``names`` the ids, vectors and floors as bytes): rows of a cell, dealt
    out by hash into parts of about ``size``."""
    sizes = df.groupBy("dim", "cell").agg(F.count("*").alias("n")).select("dim", "cell", F.ceil(F.col("n") / size).cast("long").alias("parts"))
    dealt = df.join(F.broadcast(sizes), ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("id", "salt"), F.col("parts")))

    def pack(table: pa.Table) -> pa.Table:
        vectors = table["vector"].combine_chunks().flatten().to_numpy().astype("<f8")
        return pa.table({
            "dim": table["dim"][:1], "cell": table["cell"][:1], "part": table["part"][:1], "parts": table["parts"][:1],
            names[0]: pa.array([table["id"].to_numpy().astype("<i8").tobytes()], pa.binary()), names[1]: pa.array([vectors.tobytes()], pa.binary()),
            names[2]: pa.array([table["floor"].to_numpy().astype("<f8").tobytes()], pa.binary())})

    packed = dealt.select("dim", "cell", "part", "parts", "id", "vector", "floor").groupBy("dim", "cell", "part").applyInArrow(
        pack, f"dim int, cell long, part long, parts long, {names[0]} binary, {names[1]} binary, {names[2]} binary")
    return packed


_HITS = "query_id long, vec_id long, score double"


def _searched(shards: DataFrame, asked: DataFrame, k: int, dimensions: int, confidence: float) -> DataFrame:
    """Hits of ``asked`` (id, vector, salt, floor, dim, cell) in the shards of their cells."""
    blocks = _packed(asked, BLOCK_ROWS, ("query_ids", "queries", "floors"))
    parts = shards.select("dim", "cell", "part").groupBy("dim", "cell").agg(F.max("part").alias("last"))
    # a block goes to every shard of its cell under the shard's own key, so a large cell is many tasks' work
    copies = blocks.drop("part", "parts").join(F.broadcast(parts), ["dim", "cell"]).withColumn("part", F.explode(F.sequence(F.lit(0), "last"))).drop("last")
    pairs = shards.drop("parts", "unused").hint("shuffle_hash").join(copies, ["dim", "cell", "part"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                a, b, c, d, e = (np.frombuffer(x, t) for x, t in zip(packed, ("<i8", "<f8", "<i8", "<f8", "<f8")))
                at, i, s = search(a, b.reshape(-1, dim), c, d.reshape(-1, dim), k, dimensions, confidence, e)
                yield pa.record_batch({"query_id": pa.array(c[at]), "vec_id": pa.array(i), "score": pa.array(s)})

    return pairs.select("dim", "ids", "rows", "query_ids", "queries", "floors").mapInArrow(found, _HITS)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding",
            dimensions: int = DIMENSIONS, confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k nearest of ``vectors``."""
    def own(df: DataFrame) -> DataFrame:
        v = F.col(vector).cast("array<double>")
        usable_ = df.where(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), v.alias("vector"))
        # rows that repeat an id are told apart by where they were stored
        return keep(projected(usable_, dimensions).withColumn("salt", F.monotonically_increasing_id() % 4096), "vectors")

    everything, asking = own(vectors), own(queries)
    n = everything.count()
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = _tree(everything, n)
    low = F.lit(float("-inf")).alias("floor")
    rows = keep(_in_cells(everything, tree), "vectors")
    asked = keep(_in_cells(asking, tree), "vectors")
    shards = keep(_packed(rows.select("*", low), SHARD_ROWS, ("ids", "rows", "unused")), "shards")
    first = keep(_searched(shards, asked.select("id", "vector", "salt", low, "dim", "cell"), k, dimensions, confidence), "hits")

    # the second round: each query with the k-th best of the first, in the cells within its reach
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = (
        first.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    )
    boxes = rows.groupBy("dim", "cell").agg(*[f(F.get("p", i)).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(dimensions)])
    held = boxes.toPandas()     # a row for each cell and length of vectors
    factor = stopping_factor(confidence, dimensions)
    limits = {int(d): (part["cell"].to_numpy(), part[[f"low{i}" for i in range(dimensions)]].to_numpy(), part[[f"high{i}" for i in range(dimensions)]].to_numpy())
              for d, part in held.groupby("dim")}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 512) for i in range(0, whole.num_rows, 512)):
                p = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
                home, dims, floor = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "dim", "floor"))
                for d in np.unique(dims):
                    if int(d) not in limits:
                        continue
                    cells, lowest, highest = limits[int(d)]
                    some = np.flatnonzero(dims == d)
                    far = box_distances(lowest, highest, p[some])
                    bound = np.where(np.isfinite(floor[some]), reach(np.where(np.isfinite(floor[some]), floor[some], 0), factor), np.inf)
                    i, j = np.nonzero((far < bound[:, None]) & (cells != home[some][:, None]))
                    take = pa.array(some[i])
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(take) for c in ("id", "vector", "salt", "floor", "dim")), pa.array(cells[j].astype(np.int64))],
                        names=["id", "vector", "salt", "floor", "dim", "cell"])

    going_on = asked.join(kth, "id", "left").select("id", "vector", "p", "salt", "cell", "dim", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    wider = keep(going_on.mapInArrow(spread, "id long, vector array<double>, salt long, floor double, dim int, cell long"), "asked")
    second = _searched(shards, wider, k, dimensions, confidence)
    return (
        first.unionByName(second).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

"""The best items of every user by inner product, without all pairs.

Items lie in blocks by falling norm of their factors.  An inner product is at most the product of
the norms, so a user whose n-th best so far is at least its own norm times a block's
largest norm needs neither that block nor any after it.

Blocks travel ``SPAN`` at a time, as a chunk.  Two rounds.  In the first every user meets the first
chunk, which gives it a floor.  In the second, users are sorted by how far down the list they have to
go (the floor over their norm) and cut into crowds of like depth; a crowd meets just the chunks above
its depth, and each of its users only the blocks above its own, which falls while it finds better
ones.  A task holds one chunk and a few crowds.  What every task gets is the first chunk and, for steps
of a 64th of an octave of the norm, the last chunk that reaches it.

Products are taken in single precision first, a tile of users and a block at a time; only those
that may be above the floor, with room for the rounding, are taken in double precision and sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import row_index
from millrace.scratch import keep

ITEM_BLOCK = 2048
#: Blocks of a chunk.
SPAN = 32
#: Users of a crowd, crowds that share a task's chunk, and users of a tile.
USER_BLOCK = 8192
CROWDS = 8
TILE = 256
STEPS = 64      # an octave
#: Share by which rounding may lift a product above the product of the norms.
SLACK = 1e-12
#: The same for a product of unit vectors in single precision, by the number of dimensions.
SINGLE = 2.4e-7


_NEVER = -(1 << 40)


def _step(bound):
    """A norm or bound as a number of steps; all that is not above zero is the lowest."""
    return F.when(bound > 0, F.floor(F.log2(bound) * STEPS)).otherwise(F.lit(_NEVER + 1)).cast("long")


def _packed(df: DataFrame, size: int) -> DataFrame:
    """(block, ids, rows, bounds, best): ``size`` neighbours by ``idx`` a row."""
    def pack(table: pa.Table) -> pa.Table:
        t = table.sort_by("idx")
        rows = t["vector"].combine_chunks().flatten().to_numpy().astype("<f8")
        return pa.table({
            "block": t["block"][:1], "ids": [t["id"].to_numpy().astype("<i8").tobytes()], "rows": [rows.tobytes()],
            "bounds": [t["bound"].to_numpy().astype("<f8").tobytes()], "top": pa.array([t["bound"].to_numpy().max()], pa.float64()),
            "low": pa.array([t["bound"].to_numpy().min()], pa.float64())})

    cut = df.select((F.col("idx") / size).cast("long").alias("block"), "idx", "id", "vector", "bound")
    packed = cut.groupBy("block").applyInArrow(pack, "block long, ids binary, rows binary, bounds binary, top double, low double")
    return keep(packed, "factor-blocks")


class _Best:
    """The n best items of some users so far; ties to the smaller id."""

    def __init__(self, vectors: np.ndarray, floors: np.ndarray, n: int):
        self.vectors, self.n = vectors, n
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.unit = (vectors / self.norms[:, None]).astype(np.float32)
        self.floors = floors.copy()
        self.ids = np.full((len(vectors), n), np.iinfo(np.int64).max)
        self.scores = np.full((len(vectors), n), -np.inf)
        self.met = np.zeros(len(vectors), np.int32)

    def meet(self, ids: np.ndarray, rows: np.ndarray, norms: np.ndarray, block: int) -> None:
        """Items by falling norm, a block at a time."""
        top = norms[0] or 1.0
        single, room = (rows / top).astype(np.float32), SINGLE * (rows.shape[1] + 4)
        for at in range(0, len(ids), block):
            wants = np.flatnonzero(self.floors <= self.norms * norms[at] * (1 + SLACK))
            if not len(wants):
                return
            self.met[wants] += 1
            for i in range(0, len(wants), TILE):
                part = wants[i:i + TILE]
                near = self.unit[part] @ single[at:at + block].T
                least = self.floors[part] / (self.norms[part] * top) - room
                new = np.isneginf(least)
                if near.shape[1] > self.n and new.any():    # the n-th of this block is a floor
                    least[new] = np.partition(near[new], -self.n, axis=1)[:, -self.n] - 2 * room
                which, item = np.nonzero(near >= least.astype(np.float32)[:, None])
                if len(which):
                    self._take(part[which], ids[at + item], (self.vectors[part[which]] * rows[at + item]).sum(axis=1))

    def _take(self, which: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        order = np.lexsort((ids, -scores, which))
        which, ids, scores = which[order], ids[order], scores[order]
        users, start, count = np.unique(which, return_index=True, return_counts=True)
        place = np.arange(len(which)) - np.repeat(start, count)
        row = np.repeat(np.arange(len(users)), count)[place < self.n]
        more_ids, more = np.full((len(users), self.n), np.iinfo(np.int64).max), np.full((len(users), self.n), -np.inf)
        more_ids[row, place[place < self.n]], more[row, place[place < self.n]] = ids[place < self.n], scores[place < self.n]
        both_ids, both = np.hstack([self.ids[users], more_ids]), np.hstack([self.scores[users], more])
        best = np.lexsort((both_ids, -both), axis=1)[:, :self.n]
        self.ids[users], self.scores[users] = np.take_along_axis(both_ids, best, axis=1), np.take_along_axis(both, best, axis=1)
        self.floors[users] = np.maximum(self.floors[users], self.scores[users, -1])

    def columns(self, of: np.ndarray | slice = slice(None)) -> dict[str, pa.Array]:
        there = np.isfinite(self.scores[of])
        offsets = pa.array(np.concatenate([[0], np.cumsum(there.sum(axis=1))]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[of][there])) for x in (self.ids, self.scores)]
        return {"items": lists[0], "scores": lists[1], "blocks": pa.array(self.met[of])}


def _unpacked(row: dict, *names: str) -> list[np.ndarray]:
    ids, rows, bounds = (row[n] for n in names)
    ids = np.frombuffer(ids, "<i8")
    return [ids, np.frombuffer(rows, "<f8").reshape(len(ids), -1), np.frombuffer(bounds, "<f8")]


def best_by_product(users: DataFrame, items: DataFrame, n: int, item_block: int = ITEM_BLOCK, user_block: int = USER_BLOCK) -> DataFrame:
    """Rows (user, rank from 1, item, score, blocks): each user's ``n`` items of largest product, ties to
    the smaller item, and how many item blocks the user met.

    ``users`` and ``items`` have columns ``id`` (long) and ``vector`` (array of numbers, all of one length).
    Without items, and for users whose vector is null or zero, there are no rows.  Ids are distinct.
    """
    def own(df: DataFrame) -> DataFrame:
        vector = F.col("vector").cast("array<double>")
        norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))
        return df.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).select(F.col("id").cast("long").alias("id"), vector.alias("vector"), norm.alias("norm"))

    falling = row_index(own(items).withColumn("__less", -F.col("norm")), ["__less", "id"], "idx")
    chunks = _packed(falling.withColumn("bound", F.col("norm")), item_block * SPAN)
    people = keep(own(users).where("norm > 0"), "factors")

    # first round: everyone meets the first chunk, so it goes to every task; its size is fixed
    first = chunks.where("block = 0").toArrow().to_pylist()
    if not first:
        return people.sparkSession.createDataFrame([], "user long, rank int, item long, score double, blocks int")
    held = people.sparkSession.sparkContext.broadcast(_unpacked(first[0], "ids", "rows", "bounds"))

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, user_block):
                part = batch.slice(at, user_block)
                vectors = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
                best = _Best(vectors, np.full(len(vectors), -np.inf), n)
                best.meet(*held.value, item_block)
                # below this item norm nothing can enter; with fewer than n items so far everything can
                bound = np.where(np.isneginf(best.floors), -1.0, np.maximum(best.floors / best.norms * (1 - SLACK), -1.0))
                yield pa.record_batch({"id": part.column(0), "vector": part.column(1), "bound": pa.array(np.where(bound < 0, -1.0, bound)), **best.columns()})

    met = keep(people.mapInArrow(floors, "id long, vector array<double>, bound double, items array<long>, scores array<double>, blocks int"), "factor-floors")

    reach = chunks.where("block > 0").groupBy(_step(F.col("top")).alias("step")).agg(F.max("block").alias("last")).collect()
    steps = np.array(sorted(r["step"] for r in reach), np.int64)
    lasts = np.array([r["last"] for r in sorted(reach, key=lambda r: r["step"])], np.int64)
    last_of = np.maximum.accumulate(lasts[::-1])[::-1]
    # users with like bounds share a crowd; those that nothing can improve are left out
    going_on = met.where(_step(F.col("bound")) <= (int(steps[-1]) if len(steps) else _NEVER))
    crowds = _packed(row_index(going_on.select("id", "vector", "bound"), ["bound", "id"], "idx"), user_block)

    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for crowd, low in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = int(np.searchsorted(steps, low))
                if at < len(steps):
                    yield pa.record_batch({"crowd": pa.array([crowd] * int(last_of[at])), "block": pa.array(np.arange(1, last_of[at] + 1))})

    spans = crowds.select("block", _step(F.col("low"))).mapInArrow(span, "crowd long, block long").withColumn("part", F.floor(F.col("crowd") / CROWDS))
    people_of = spans.join(crowds.select(F.col("block").alias("crowd"), "ids", "rows", "bounds"), "crowd")
    items_of = spans.select(F.col("block").alias("chunk"), F.col("part").alias("share")).distinct().join(
        chunks.select(F.col("block").alias("chunk"), "ids", "rows", "bounds"), "chunk")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        items = [_unpacked(r, "ids", "rows", "bounds") for r in right.to_pylist()]
        for crowd in left.to_pylist():
            ids, vectors, bounds = _unpacked(crowd, "ids", "rows", "bounds")
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            best = _Best(vectors, np.where(bounds < 0, -np.inf, bounds * norms * (1 - SLACK)), n)
            for chunk in items:
                best.meet(*chunk, item_block)
            of = np.flatnonzero(best.met)
            out.append(pa.table({"user": pa.array(ids[of]), **best.columns(of)}))
        return pa.concat_tables(out) if out else pa.table({"user": pa.array([], pa.int64()), **_Best(np.ones((0, 1)), np.zeros(0), n).columns()})

    kind = "user long, items array<long>, scores array<double>, blocks int"
    found = met.select(F.col("id").alias("user"), "items", "scores", "blocks").unionByName(
        people_of.groupBy("block", "part").cogroup(items_of.groupBy("chunk", "share")).applyInArrow(meet, kind))
    # larger score first, then smaller item: both fall in this order
    entry = F.transform(F.arrays_zip("items", "scores"), lambda x: F.struct(x["scores"].alias("score"), (-x["items"]).alias("less")))
    merged = found.select("user", "blocks", entry.alias("entries")).groupBy("user").agg(
        F.slice(F.sort_array(F.flatten(F.collect_list("entries")), asc=False), 1, n).alias("entries"), F.sum("blocks").cast("int").alias("blocks"))
    return merged.select("user", "blocks", F.posexplode("entries").alias("at", "entry")).select(
        "user", (F.col("at") + 1).alias("rank"), (-F.col("entry.less")).alias("item"), F.col("entry.score").alias("score"), "blocks")

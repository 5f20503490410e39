"""Sharding by balanced label propagation.

Nodes start dealt out evenly.  In each round nodes wish themselves to the shard where most
of their neighbours are; a shard takes what it has room for, and pairs of shards may always
swap as many nodes as both directions wish for.  Rounds end when nobody moves, or when the
links that are not cut have not become more for ``PATIENCE`` rounds; the best round counts.  In
the end shards are levelled: shard sizes in rows differ by one at most, surplus nodes and nodes
without links fill the gaps.

DataFrame work only.  A node with very many neighbours costs one row per shard after partial
counts.  Null or repeated ids and null texts are rows like any other; a null text counts as
empty; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.numbering import numbered
from millrace.scratch import keep

#: Rounds without a better cut before propagation ends.
PATIENCE = 4


def star_links(nodes: DataFrame, node: str, group: str) -> DataFrame:
    """Links (a, b) from the first node of each group to its others."""
    hubs = nodes.groupBy(group).agg(F.min(node).alias("a"), F.count("*").alias("n")).where("n > 1")
    return nodes.join(hubs, group).where(F.col(node) != F.col("a")).select("a", F.col(node).alias("b"))


def propagate(links: DataFrame, shards: int, room: int, patience: int = PATIENCE) -> DataFrame:
    """node, shard of the linked nodes.  ``room``: nodes that a shard may hold."""
    both = keep(links.union(links.selectExpr("b", "a")), "links")
    spread = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")
    state = keep(both.select(F.col("a").alias("node")).distinct().withColumn("shard", spread), "labels")
    best_state, most, since, k = state, -1, 0, 0
    while True:
        seen = both.join(state.select(F.col("node").alias("b"), "shard"), "b").groupBy("a", "shard").agg(F.count("*").alias("n"))
        best = seen.groupBy(F.col("a").alias("node")).agg(F.max(F.struct("n", (-F.col("shard")).alias("last"))).alias("best"), F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("near"))
        wish = (
            state.join(best, "node")
            .withColumn("to", (-F.col("best.last")).cast("int"))
            .withColumn("here", F.coalesce(F.element_at("near", F.col("shard")), F.lit(0)))
            # half of the nodes may move in a round, so that neighbours don't change places
            .withColumn("wants", F.col("best.n") > F.col("here"))
            .withColumn("moves", F.col("wants") & (F.xxhash64("node", F.lit(k)) % 2 == 0))
            .select("node", "shard", "to", "here", "wants", "moves")
        )
        wish = keep(wish, "labels")
        # one row for each pair of shards
        counts = wish.groupBy("shard", "to").agg(
            F.count("*").alias("n"), F.sum("here").alias("here"), F.count_if("wants").alias("wants"), F.count_if("moves").alias("moves")).collect()
        uncut = sum(r.here for r in counts)
        most, best_state, since = (uncut, state, 0) if uncut > most else (most, best_state, since + 1)
        if not any(r.wants for r in counts) or since >= patience:
            return best_state
        held = {j: sum(r.n for r in counts if r.shard == j) for j in range(shards)}
        want = {(r.shard, r.to): r.moves for r in counts if r.moves}
        free = {j: max(0, room - held[j]) for j in range(shards)}
        asked = {j: sum(n for (_, to), n in want.items() if to == j) for j in range(shards)}
        share = [
            (i, j, min(1.0, (min(n, want.get((j, i), 0)) + free[j] * n / asked[j]) / n)) for (i, j), n in want.items()
        ]
        quota = state.sparkSession.createDataFrame(share, "shard int, to int, share double")
        chance = F.pmod(F.xxhash64(F.lit(k), "node"), F.lit(1 << 30)) / (1 << 30)
        state = keep(
            wish.join(F.broadcast(quota), ["shard", "to"], "left")
            .select("node", F.when(F.col("moves") & (chance < F.col("share")), F.col("to")).otherwise(F.col("shard")).alias("shard")),
            "labels")
        k += 1


def levelled(nodes: DataFrame, state: DataFrame, shards: int) -> DataFrame:
    """node, shard of all nodes, counts at most one apart: linked nodes stay where they are as
    far as there is room, the rest fills the gaps."""
    total = nodes.count()
    fair = [total // shards + (j < total % shards) for j in range(shards)]
    spark = nodes.sparkSession
    per_shard = spark.createDataFrame(list(enumerate(fair)), "shard int, fair long")
    placed = keep(numbered(state, "shard", "node", "at", total).join(F.broadcast(per_shard), "shard").where("at < fair").select("node", "shard"), "level")
    held = {r.shard: r.n for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    ends = list(accumulate(fair[j] - held.get(j, 0) for j in range(shards)))
    rest = keep(nodes.join(placed, "node", "left_anti").select("node", F.lit(0).alias("all")), "level")
    where = F.lit(shards - 1)
    for j in reversed(range(shards - 1)):
        where = F.when(F.col("at") < ends[j], F.lit(j)).otherwise(where)
    filled = numbered(rest, "all", "node", "at", total).select("node", where.cast("int").alias("shard"))
    return placed.union(filled)


def assign(nodes: DataFrame, links: DataFrame, shards: int) -> DataFrame:
    """node, shard, slot (0, 1, ... in each shard) of every row of ``nodes`` (node, unique).
    ``links`` (a, b): each pair of neighbours once."""
    total = nodes.count()
    state = propagate(links, shards, total // shards)
    final = keep(levelled(nodes, state, shards), "shards")
    return numbered(final, "shard", "node", "slot", total)


def cut(links: DataFrame, placed: DataFrame) -> DataFrame:
    """links, cut: how many links there are and how many lead into another shard."""
    a, b = placed.select(F.col("node").alias("a"), F.col("shard").alias("s")), placed.select(F.col("node").alias("b"), F.col("shard").alias("t"))
    return links.join(a, "a").join(b, "b").agg(F.count("*").alias("links"), F.count_if(F.col("s") != F.col("t")).alias("cut"))


def equal_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Stored: node (unique), all columns but the text, size, text_crc32, and the digest by
    which equal texts are linked.  Columns of these names are replaced."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return keep(docs.select(
        F.monotonically_increasing_id().alias("node"), *[c for c in docs.columns if c not in (text, "node", "size", "text_crc32", "digest")],
        (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.md5(body).alias("digest")), "texts")

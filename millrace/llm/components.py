"""Connected components of links between integers, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.scratch import keep


def components(edges: DataFrame) -> DataFrame:
    """node, top (the smallest node that links lead to) of every node of ``edges`` (a, b).

    Each round hangs every node's larger neighbours on its smallest one and then the nodes
    of a star on the star's smallest, until nothing changes; chains shorten by half or more
    a round.  Rounds are tables in the shared folder, so lost executors cost one round.
    """
    links = keep(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "links")
    while True:
        both = links.union(links.selectExpr("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").selectExpr("b AS a", "m AS b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").selectExpr("explode(array(struct(a, m AS b), struct(b AS a, m AS b))) AS e") \
            .selectExpr("e.a", "e.b").where("a <> b").distinct()
        after = keep(small, "links")
        if after.exceptAll(links).isEmpty() and links.exceptAll(after).isEmpty():
            return after.groupBy("a").agg(F.min("b").alias("top")).withColumnRenamed("a", "node") \
                .union(after.select("b", "b").distinct())
        links = after

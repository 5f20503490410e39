"""Filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import filters
from millrace.queries.registry import query, table


@query("filter_in_and", """
    SELECT l_orderkey, l_partkey, l_returnflag, l_linenumber FROM lineitem
    WHERE l_returnflag IN ('R', 'A') AND l_linenumber IN (1, 3, 5)""")
def filter_in_and(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where(
        "l_returnflag IN ('R', 'A') AND l_linenumber IN (1, 3, 5)"
    ).select("l_orderkey", "l_partkey", "l_returnflag", "l_linenumber")


@query("filter_not_null", """
    SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL
    UNION ALL
    SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL""")
def filter_not_null(spark, sf_dir):
    labelled = table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left"
    )
    return labelled.where("quality IS NOT NULL").union(labelled.where(F.col("quality").isNull()))


@query("filter_compare", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000""")
def filter_compare(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(
        "o_orderstatus == 'F' AND o_totalprice > 250000"
    ).select("o_orderkey", "o_totalprice")


@query("filter_having", """
    SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 6""")
def filter_having(spark, sf_dir):
    return filters.keys_with_count_above(table(spark, sf_dir, "lineitem"), ["l_orderkey"], 6)


@query("filter_global_max", """
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem)""")
def filter_global_max(spark, sf_dir):
    return filters.at_global_max(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"),
        "l_quantity",
    )

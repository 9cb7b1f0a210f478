"""Connected components of an edge table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceframe.llm.common import let_go, placed, removed


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label``: the smallest node that ``a``-``b`` edges lead to. Only nodes with edges.

    Each round takes the smallest label among neighbours, then that label's own label, and stores
    the result; the number of rounds grows with the logarithm of the longest chain. Aggregation
    is map-side first, so a node with very many edges is no single task's work. Rounds are tables, of which
    readers take many small files in one task, and go when the next one is whole.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both, edges_at = placed(both.where("a <> b").distinct())
    table, at = placed(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("label")
    ))
    while True:
        labels = table.select("node", "label")
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels.node == near.a).select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        moved = lower.join(jump, lower.low == jump.at, "left").select(
            "node", F.least("low", F.coalesce("further", "low")).alias("label"), F.col("label").alias("was")
        )
        before = at
        table, at = placed(moved)
        done = table.where("label <> was").isEmpty()
        for old in [before, edges_at] if done else [before]:
            removed(spark, old)
        let_go(spark)
        if done:
            return table.select("node", "label")

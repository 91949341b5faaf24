"""Connected components by hooking and contracting, in joins and minimum aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeflow.llm.common import cut


def _ordered(links: DataFrame) -> DataFrame:
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node reachable.

    In each round every node hooks to the smallest node of its neighbourhood, parents take their parent's parent until
    none changes, and the links are carried over; local minima alone are left, at most half of the nodes. A hub's links
    meet in a map-side combined minimum and in joins that Spark can split, never in one group. Links of a node with
    itself say nothing; no links give no rows.
    """
    links = cut(_ordered(links))
    labels: DataFrame | None = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(links.select("b", "a"))
        hooks = cut(both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("parent")))
        jumps, moved = hooks.withColumnRenamed("parent", "component"), True
        while moved:
            above = jumps.select(F.col("node").alias("component"), F.col("component").alias("next"))
            farther = cut(jumps.join(above, "component").select("node", F.col("next").alias("component"), (F.col("next") < F.col("component")).alias("moved")))
            jumps, moved = farther.select("node", "component"), not farther.where("moved").isEmpty()
        if labels is None:
            labels = jumps
        else:
            later = jumps.select(F.col("node").alias("component"), F.col("component").alias("next"))
            labels = cut(labels.join(later, "component", "left").select("node", F.coalesce("next", "component").alias("component")))
        ends = links
        for end in ("a", "b"):
            ends = ends.join(jumps.select(F.col("node").alias(end), F.col("component").alias(f"{end}_to")), end)
        links = cut(_ordered(ends.select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))))
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels

"""Connected components by alternating large-star and small-star joins (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from demandkit.llm.common import checkpointed


def _signature(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the smallest node reachable.

    Loops and repeated edges are harmless, edges with a null end are no links. Each round is two
    aggregates and two joins over the edges, which never grow in number; the rounds grow with the
    logarithm of the longest path. No group is gathered: a node with very many edges only
    contributes a minimum, and its edges are dealt out by the join.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    edges = checkpointed(edges)
    before = _signature(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: larger neighbours point at the smallest of the neighbourhood
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours point at the smallest of them
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.union(lowest.select("u", F.col("m").alias("v"))).distinct())
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())

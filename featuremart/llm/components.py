"""Connected components by alternating star contraction, one round of joins at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.sources.scratch import cut


def _lowest_neighbour(pairs: DataFrame) -> DataFrame:
    """``u, low``: the smallest of each node and its neighbours; summed up before the shuffle."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))


def _round(edges: DataFrame) -> DataFrame:
    """A large star, then a small star. ``edges``: distinct ``u, v`` with v < u."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = both.join(_lowest_neighbour(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    large = large.where("u != v").distinct()
    lowest = _lowest_neighbour(large)
    small = large.join(lowest, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return small.unionByName(lowest.select("u", F.col("low").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node with an edge, where root is the smallest node of its component.

    ``edges`` has long columns ``u`` and ``v``. Every round is written to shared scratch, so a lost
    executor costs a round at most; rounds grow as the logarithm of the longest chain. It ends when a
    round changes nothing: then each node points at its root. Only two numbers a round reach the driver.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = cut(edges.distinct(), "edges")
    before = None
    while True:
        total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        state = edges.agg(F.count("*"), total).first()
        if state == before or not state[0]:
            break
        before = state
        edges = cut(_round(edges), "edges")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

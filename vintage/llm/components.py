"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.staging import stage


def _smallest(edges: DataFrame) -> DataFrame:
    """(u, least): the smallest of u and its neighbours, for edges given in both directions as (u, v)."""
    return edges.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = both.join(_smallest(both), "u").filter("v > u")
    return linked.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges point from the larger node u to the smaller v.
    near = _smallest(edges)
    linked = edges.join(near, "u").filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return linked.union(near.select("u", F.col("least").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v; u <> v), root being its component's smallest node.

    Each step keeps components and moves links to smaller nodes, until every node links to its root
    alone. Steps are staged, and the driver sees a count and a checksum of each. A node with many
    links is a skewed join key that the adaptive planner splits; its minimum is combined before the
    shuffle.
    """
    current = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if tuple(state) == seen or not state[0]:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = tuple(state)
        current = stage(_small_star(_large_star(current)))

"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum and a join on the node, so a node with very
many neighbours is aggregated map-side and its join is one that AQE can split;
no neighbour list is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(edges: DataFrame) -> DataFrame:
    """Links the neighbours in ``edges(u, v)`` of each u, and u, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component is the smallest node reachable.

    Self-links, repeated links and either direction are allowed; links with a
    null end are left out; no links give no rows. Every round is written to
    the shared checkpoint folder, so the plan stays short and a lost executor
    costs at most one round. Rounds grow with the logarithm of the nodes.
    """
    now = materialize(edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: the larger neighbours of each node go to the smallest of its neighbourhood
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: the node and its smaller neighbours go to the smallest
        small = _star(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = materialize(small, "links")
        state = now.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).head()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

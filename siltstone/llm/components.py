"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, materialize


def _star(edges: DataFrame, total: int, large: bool) -> DataFrame:
    """edges(u, v). Large star: neighbours above u go to the smallest of u and its neighbours; small star: those below."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n")), "stars")
    joined = attach(both, "u", least, "n", 2 * total)
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges(u long, v long)``; the root is the component's smallest node.

    Each step is written to the shared folder. A node with many neighbours is never one task's group: only sums and
    minima are formed by node, and the join back sends the few hot nodes by broadcast."""
    edges = materialize(edges.where("u <> v").distinct(), "edges")
    before = None
    while True:
        total = edges.count()
        if not total:
            break
        edges = materialize(_star(materialize(_star(edges, total, True), "large-star"), total, False), "small-star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())

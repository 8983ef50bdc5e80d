"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.workspace import Workspace


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Links every neighbour of a node to the smallest node among them and itself.

    ``larger``: those above the node only; otherwise those up to it. The smallest is found by a
    partial aggregate and joined back, so that a node with very many links is no single task.
    """
    both = edges.union(edges.select("b", "a")) if larger else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.join(least.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a"))
    if larger:
        return linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return linked.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(own)


def components(space: Workspace, links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link, root being the smallest node of its component.

    ``links`` has columns a and b, both long and not null. Alternates large and small stars, which
    needs about log n rounds; every round is written, and only its row count and checksum reach the driver.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = space.pin(ordered.distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct()
        seen = state
        starred = _star(_star(edges, True).distinct(), False).filter("a <> b").distinct()
        following = space.pin(starred, "links")
        space.drop(edges)
        edges = following

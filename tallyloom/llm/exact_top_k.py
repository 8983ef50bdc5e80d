"""Exact top-k inner products by a dual-tree search: queries and data are in cover trees of one net.

A task holds the tree of a group of queries and those of a few blocks. Pairs of nodes are taken best first;
a pair goes if its covering radii cannot reach the worst kth score among the node's queries, else the wider node is
split. The points of two leaves are compared exactly, for those queries whose own bound reaches the leaf.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.cover_forest import (
    BLOCK_ROWS, GROUP_ROWS, LEAST, MOST, Found, Side, cast_net, cells_for, indexed, search, valid,
)
from tallyloom.llm.cover_tree import group_bounds, product_bounds
from tallyloom.llm.workspace import Workspace


def dual_descent(found: Found, block: Side) -> None:
    """Offers every query the points of ``block`` that its node pairs do not rule out."""
    queries, data = found.queries.tree, block.tree
    with np.errstate(over="ignore"):
        squares = np.square(queries.points).sum(axis=1)
    ends = list(zip(queries.start, queries.stop))
    own_low, own_high = product_bounds(data, queries.points)
    low, high = group_bounds(data, queries.centres[:, :-1], queries.radius, (
        np.array([squares[a:b].min() for a, b in ends]), np.array([squares[a:b].max() for a, b in ends]),
    ))
    waiting = [(-high[0, 0], 0, 0)]
    while waiting:
        _, q, d = heapq.heappop(waiting)
        at = slice(queries.start[q], queries.stop[q])
        open_ = found.needs(low[q, d], high[q, d], at)
        if not open_.any():
            continue
        if queries.leaf(q) and data.leaf(d):
            open_ &= found.needs(own_low[at, d], own_high[at, d], at)
            if open_.any():
                found.offer(queries.start[q] + np.flatnonzero(open_), block, data.start[d], data.stop[d])
        elif data.leaf(d) or (not queries.leaf(q) and queries.radius[q] >= data.radius[d]):
            for child in queries.below(q):
                heapq.heappush(waiting, (-high[child, d], child, d))
        else:
            for child in data.below(d):
                heapq.heappush(waiting, (-high[q, child], q, child))


def top_scores(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, every: int = 50,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` the ``k`` highest scores.

    A component x counts as floor(256 * x), a score is an integer inner product; candidates are all rows but the
    query's own, ties go to the smaller id. Scores are exact; one beyond a long is told as the long nearest to it.

    - Rows with a null id, a null vector or one with a null or non-finite component take no part.
    - Vectors of unlike length are no candidates of each other; empty ones have the score 0.
    - Repeated rows are rows: each is a query, and a candidate of the others. With fewer than ``k`` candidates
      all are returned. An empty table gives an empty table; other columns, whatever their names, are not read.
    """
    space = Workspace(vectors.sparkSession)
    rows = space.pin(vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"),
        F.lit(None).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"),
    ).filter(F.col("id").isNotNull() & valid(F.col("v"))), "vectors")
    queries = rows.filter(F.col("id") % every == 0)
    n, asking = rows.count(), queries.count()
    net = cast_net(rows, cells_for(n, BLOCK_ROWS))
    blocks = indexed(space, rows, net, cells_for(n, BLOCK_ROWS), BLOCK_ROWS, by_label=False)
    groups = indexed(space, queries, net, cells_for(asking, GROUP_ROWS), GROUP_ROWS, by_label=False)
    windows = queries.select(
        "row", F.lit(0).cast("bigint").alias("window"), F.lit(LEAST).alias("low"), F.lit(MOST).alias("high")
    )
    return search(space, groups, blocks, net, windows, dual_descent, k).select(
        F.col("id").alias("query_id"), "rank", F.col("hit_id").alias("vec_id"), "score"
    )

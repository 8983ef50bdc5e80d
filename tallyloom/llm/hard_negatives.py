"""Hard negatives by best-first descent of cover trees over norm-augmented candidates.

An anchor's positives are the best scores of its own label; every positive makes a window of scores, and the
negatives are the best scores of other labels inside it. A group of anchors descends a block's tree together:
each node's covering radius bounds the inner products of each anchor with all below it, the node with the highest
bound comes first, anchors none of whose windows it can reach leave it, and leaves are verified exactly.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.cover_forest import (
    BLOCK_ROWS, GROUP_ROWS, LEAST, MOST, Found, Side, cast_net, cells_for, indexed, search, valid,
)
from tallyloom.llm.cover_tree import product_bounds
from tallyloom.llm.workspace import Workspace


def best_first(found: Found, block: Side) -> None:
    """Offers the anchors the points of ``block`` whose nodes reach into their windows."""
    tree = block.tree
    low, high = product_bounds(tree, found.queries.tree.points)
    waiting = [(-high[:, 0].max(), 0)]
    while waiting:
        _, node = heapq.heappop(waiting)
        open_ = found.needs(low[:, node], high[:, node])
        if not open_.any():
            continue
        if tree.leaf(node):
            found.offer(np.flatnonzero(open_), block, tree.start[node], tree.stop[node])
        else:
            for child in tree.below(node):
                heapq.heappush(waiting, (-high[open_, child].max(), child))


def _share(score: str, percent: int) -> Column:
    """percent * score / 100 as an exact decimal."""
    return F.col(score).cast("decimal(20,0)") * F.lit(percent) / F.lit(100).cast("decimal(3,0)")


def hard_negatives(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, every: int = 50,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``. A component x counts as floor(256 * x), a score
    is the integer inner product with the anchor, higher ones come first, then smaller ids. An anchor's
    positives are its first ``positives`` other rows of its label; for each of them the first ``negatives`` rows of
    other labels are returned whose score is ``least`` to ``most`` percent of the positive's. Scores are
    exact; one beyond a long is told as the long nearest to it.

    - Rows with a null id or label, a null vector or one with a null or non-finite component take no part.
    - Vectors of unlike length do not meet; empty ones have the score 0.
    - Repeated rows are rows: each is an anchor, and another row of the same label to the others.
    - A positive with a negative score has no negatives, as its window is empty. An anchor without
      positives, or without negatives, has no rows; an empty table gives an empty table. Other columns,
      whatever their names, are not read.
    """
    space = Workspace(vectors.sparkSession)
    rows = space.pin(vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"),
    ).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & valid(F.col("v"))), "vectors")
    anchors = rows.filter(F.col("id") % every == 0)
    n, asking = rows.count(), anchors.count()
    net = cast_net(rows, cells_for(n, BLOCK_ROWS))
    blocks = indexed(space, rows, net, cells_for(n, BLOCK_ROWS), BLOCK_ROWS, by_label=True)
    cells = cells_for(asking, GROUP_ROWS)
    groups = indexed(space, anchors, net, cells, GROUP_ROWS, by_label=True)
    all_scores = anchors.select(
        "row", F.lit(0).cast("bigint").alias("window"), F.lit(LEAST).alias("low"), F.lit(MOST).alias("high")
    )
    near = space.pin(search(space, groups, blocks, net, all_scores, best_first, positives, "same").select(
        "row", (F.col("rank") - 1).cast("bigint").alias("window"), F.col("hit_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    ), "positives")
    windows = near.filter("positive_score >= 0").select(
        "row", "window", F.ceil(_share("positive_score", least)).cast("bigint").alias("low"),
        F.floor(_share("positive_score", most)).cast("bigint").alias("high"),
    )
    groups = indexed(space, anchors.join(windows.select("row").distinct(), "row", "left_semi"), net, cells, GROUP_ROWS, by_label=False)
    found = search(space, groups, blocks, net, windows, best_first, negatives, "other")
    return found.join(near, ["row", "window"]).select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("hit_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )

"""A cover tree over all vectors of a table: its top over the table, its lower part in blocks.

The top level is a net of centres, taken farthest first from a bounded sample of vectors: each is at least as far
from the others as any sampled vector is from its nearest one, and any prefix of the net is one too. Every
vector belongs to the cell of its nearest centre; a cell, however hot, is cut by hash into blocks of bounded
size, and a task builds the tree of each. Queries are indexed by the same net into groups.

Searching descends both sides together. Pairs of cells are a bounded table; equi-joins on it give the pairs
of groups and blocks, of which those out of reach of every query's windows are dropped by their radii before any
vector moves. First each group searches one block of its own cell; its worst kth scores then prune the pairs with
all others. Pairs go to tasks a few blocks a time, and a lost executor costs those.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.cover_tree import CoverTree, grow, integers, scores
from tallyloom.llm.workspace import Workspace

#: Vectors the net is taken from, fewer where they are long, and the most cells it gets.
SAMPLE, CELLS = 4096, 256
#: Rows of a block, queries of a group, components that either may have in all, blocks a task searches at a time.
BLOCK_ROWS, GROUP_ROWS, COMPONENTS, CHUNK = 2048, 512, 1 << 21, 16
#: Cells of equal labels are told apart by so many buckets.
BUCKETS = 64

_LONG = np.iinfo(np.int64)
LEAST, MOST = int(_LONG.min), int(_LONG.max)


def valid(vector: Column) -> Column:
    """Not null and without a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def cells_for(rows: int, size: int) -> int:
    """Cells of some four blocks or groups each, at most ``CELLS``."""
    return max(1, min(CELLS, rows // (4 * size)))


class Net(NamedTuple):
    """Centres of the cells by the length of their vectors."""

    centres: dict[int, np.ndarray]

    def cells(self, vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest of the first ``most`` centres, and the distance from it."""
        own = self.centres.get(vectors.shape[1], np.zeros((1, vectors.shape[1])))[:most]
        best, cell = np.full(len(vectors), np.inf), np.zeros(len(vectors), np.int64)
        with np.errstate(over="ignore", invalid="ignore"):
            for at, centre in enumerate(own):
                d = np.sqrt(np.square(vectors - centre).sum(axis=1))
                d = np.where(np.isnan(d), np.inf, d)
                closer = d < best
                best[closer], cell[closer] = d[closer], at
        return cell, best


def cast_net(rows: DataFrame, cells: int) -> Net:
    """The net over a sample of the ``v`` of ``rows`` that has the lowest hashes."""
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    sample = max(1, min(SAMPLE, COMPONENTS // max(1, longest)))
    taken = rows.select("v").orderBy(F.xxhash64("v")).limit(sample).collect()
    by_size: dict[int, list] = {}
    for (v,) in taken:
        by_size.setdefault(len(v), []).append(v)
    centres = {}
    for size, vectors in by_size.items():
        points = np.unique(integers(np.array(vectors, np.float64).reshape(len(vectors), size)), axis=0)
        with np.errstate(over="ignore", invalid="ignore"):
            picked = [points[0]]
            away = np.square(points - points[0]).sum(axis=1)
            while len(picked) < cells and away.max() > 0:
                picked.append(points[away.argmax()])
                away = np.minimum(away, np.square(points - picked[-1]).sum(axis=1))
        centres[size] = np.array(picked)
    return Net(centres)


def _pack(values: np.ndarray) -> bytes:
    """Integer-valued doubles in the fewest bytes that hold them all."""
    most = np.abs(values).max(initial=0)
    kind = np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64
    return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()


def _unpack(data: bytes, columns: int, rows: int) -> np.ndarray:
    kind = {2: np.int16, 4: np.int32, 8: np.float64}[data[0]]
    return np.frombuffer(data, kind, offset=1).astype(np.float64).reshape(rows, columns)


def indexed(space: Workspace, rows: DataFrame, net: Net, cells: int, size: int, by_label: bool) -> DataFrame:
    """(node, dim, cell, bucket, radius, members, vectors, nodes, radii): the blocks of ``rows`` with their trees.

    ``rows`` are (row, id, label, v); ``members`` and ``vectors`` stand in the order of the tree. With
    ``by_label`` rows of unlike buckets of labels are in unlike blocks. ``radius`` is around the cell's centre.
    """

    def assign(batches):
        for batch in batches:
            cell, away = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            vectors = [np.asarray(v.values, np.float64) for v in batch.column(3)]
            sizes = np.array(list(map(len, vectors)), np.int64)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                x = integers(np.array([vectors[i] for i in at]).reshape(len(at), dim))
                cell[at], away[at] = net.cells(x, cells)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes), pa.array(cell), pa.array(away)],
                [*batch.schema.names, "dim", "cell", "away"],
            )

    kinds = "row bigint, id bigint, label string, v array<double>, dim bigint, cell bigint, away double"
    bucket = F.pmod(F.xxhash64("label"), F.lit(BUCKETS)) if by_label else F.lit(0).cast("bigint")
    assigned = rows.select("row", "id", "label", "v").mapInArrow(assign, kinds).withColumn("bucket", bucket)
    key = ["dim", "cell", "bucket"]
    held = F.least(F.lit(size), F.greatest(F.lit(1), F.floor(F.lit(COMPONENTS) / F.greatest("dim", F.lit(1)))))
    parts = assigned.groupBy(*key).agg(F.count("*").alias("n")).withColumn(
        "parts", F.ceil(F.col("n") / held).cast("bigint")
    ).select(*[F.col(k).alias(f"_{k}") for k in key], "parts")
    cut = assigned.join(parts, [F.col(k) == F.col(f"_{k}") for k in key]).select(
        "row", "id", "label", "v", "away", *key, F.pmod(F.xxhash64("row"), F.col("parts")).alias("part")
    )

    def gather(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("id", "ascending"), ("row", "ascending")])
        dim = table.column("dim")[0].as_py()
        vectors = [np.asarray(v.values, np.float64) for v in table.column("v")]
        order, tree = grow(integers(np.array(vectors).reshape(len(vectors), dim)))
        table = table.take(pa.array(order)).combine_chunks()
        parts = [table.column(c).chunk(0) for c in ("row", "id", "label")]
        members = pa.StructArray.from_arrays(parts, ["row", "id", "label"])
        one = {"members": members, "nodes": pa.array(tree.nodes.ravel()), "radii": pa.array(tree.radius)}
        return pa.table({
            **{c: table.column(c).slice(0, 1) for c in key},
            "radius": pa.array([max(table.column("away").to_pylist())]),
            "vectors": pa.array([_pack(tree.points)], pa.binary()),
            **{c: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for c, x in one.items()},
        })

    blocks = cut.groupBy(*key, "part").applyInArrow(
        gather, "dim bigint, cell bigint, bucket bigint, radius double, vectors binary,"
        " members array<struct<row: bigint, id: bigint, label: string>>, nodes array<bigint>, radii array<double>",
    )
    return space.pin(blocks.withColumn("node", F.monotonically_increasing_id()), "blocks")


class Side:
    """A block's or a group's tree, with the rows, ids and labels of its points."""

    def __init__(self, block: dict, dim: int):
        members = block["members"].values
        self.row, self.id = (np.asarray(members.field(f)) for f in ("row", "id"))
        self.label = members.field("label").to_pylist()
        points = _unpack(block["vectors"].as_py(), dim, len(self.row))
        nodes = np.asarray(block["nodes"].values).reshape(-1, 5)
        self.tree = CoverTree(points, nodes, np.asarray(block["radii"].values))


class Found:
    """The best ``k`` so far of every window of every query of a group, and what is still good enough.

    A window takes the scores from ``low`` to ``high``; ``low`` rises to the kth score once there are k.
    ``rule`` says whose labels count: ``any``, the ``same`` as the query's, or ``other`` ones.
    """

    def __init__(self, queries: Side, asked: list[dict], k: int, rule: str):
        self.queries, self.k, self.rule = queries, k, rule
        width = 1 + max((w["window"] for w in asked), default=0)
        n = len(queries.row)
        self.low, self.high = np.full((n, width), MOST), np.full((n, width), LEAST)
        place = {row: at for at, row in enumerate(queries.row.tolist())}
        for w in asked:
            self.low[place[w["row"]], w["window"]] = w["low"]
            self.high[place[w["row"]], w["window"]] = w["high"]
        # Rows (score, id, row) of every query and window, best first; those beyond ``held`` are empty.
        self.best = np.zeros((3, n, width, k), np.int64)
        self.held = np.zeros((n, width), np.int64)

    def needs(self, lower: np.ndarray, upper: np.ndarray, at: slice | np.ndarray = slice(None)) -> np.ndarray:
        """Which queries may find something between the bounds, given by query or for all of them."""
        low, high = self.low[at], self.high[at]
        fits = (np.asarray(upper)[..., None] >= low - 1e-12 * np.abs(low)) | (low == LEAST)
        fits &= (np.asarray(lower)[..., None] <= high + 1e-12 * np.abs(high)) | (high == MOST)
        return (fits & (low <= high)).any(axis=-1)

    def offer(self, at: np.ndarray, block: Side, start: int, stop: int) -> None:
        """Verify the block's points from ``start`` to ``stop`` for the queries ``at``."""
        found = scores(self.queries.tree.points[at], block.tree.points[start:stop])
        allowed = self.queries.row[at][:, None] != block.row[None, start:stop]
        if self.rule != "any":
            codes = {}
            own = np.array([codes.setdefault(self.queries.label[i], len(codes)) for i in at])
            theirs = np.array([codes.setdefault(x, len(codes)) for x in block.label[start:stop]])
            allowed &= (own[:, None] == theirs[None, :]) == (self.rule == "same")
        for window in range(self.low.shape[1]):
            fits = allowed & (found >= self.low[at, window, None]) & (found <= self.high[at, window, None])
            if not fits.any():
                continue
            if fits.shape[1] > self.k:
                worst = np.partition(np.where(fits, found, LEAST), -self.k, axis=1)[:, -self.k]
                fits &= found >= worst[:, None]
            who, what = np.nonzero(fits)
            new = np.stack([found[who, what], block.id[start + what], block.row[start + what]])
            changed = np.unique(who)
            old_who, old_what = np.nonzero(np.arange(self.k) < self.held[at[changed], window, None])
            old = self.best[:, at[changed][old_who], window, old_what]
            who = np.concatenate([changed[old_who], who])
            new = np.concatenate([old, new], axis=1)
            order = np.lexsort((new[2], new[1], ~new[0], who))
            who, new = who[order], new[:, order]
            rank = np.arange(len(who)) - np.searchsorted(who, who)
            kept = rank < self.k
            self.best[:, at[who[kept]], window, rank[kept]] = new[:, kept]
            self.held[at[changed], window] = np.minimum(np.bincount(who, minlength=len(at))[changed], self.k)
            full = at[changed][self.held[at[changed], window] == self.k]
            self.low[full, window] = np.maximum(self.low[full, window], self.best[0, full, window, -1])

    def table(self) -> pa.Table:
        query, window, rank = np.nonzero(np.arange(self.k) < self.held[:, :, None])
        score, hit_id, hit_row = self.best[:, query, window, rank]
        return pa.table({
            "row": self.queries.row[query], "id": self.queries.id[query], "window": window,
            "score": score, "hit_id": hit_id, "hit_row": hit_row,
        })


Kernel = Callable[[Found, Side], None]
_FOUND = "row bigint, id bigint, window bigint, score bigint, hit_id bigint, hit_row bigint"


def _cell_pairs(space: Workspace, net: Net, blocks: DataFrame) -> DataFrame:
    """(dim, cell, bcell, dot, norm, bnorm): at most ``CELLS`` squared pairs of centres for a length of vectors."""
    tables = []
    for dim, centres in net.centres.items():
        with np.errstate(over="ignore", invalid="ignore"):
            dots, norms = centres @ centres.T, np.sqrt(np.square(centres).sum(axis=1))
        one, other = np.divmod(np.arange(dots.size), len(centres))
        tables.append(pa.table({
            "dim": np.full(dots.size, dim, np.int64), "cell": one, "bcell": other, "dot": dots.ravel(),
            "norm": norms[one], "bnorm": norms[other],
        }))
    known = [int(d) for d in net.centres]
    zero = F.lit(0).cast("bigint")
    # Lengths that the sample missed have one cell around zero.
    pairs = blocks.filter(~F.col("dim").isin(known)).select("dim").distinct().select(
        "dim", zero.alias("cell"), zero.alias("bcell"), *[F.lit(0.0).alias(c) for c in ("dot", "norm", "bnorm")]
    )
    if tables:
        pairs = pairs.unionByName(space.spark.createDataFrame(pa.concat_tables(tables)))
    return pairs


def _within(bound_radius: str) -> Column:
    """Whether a group's windows reach what lies around a centre within a radius."""
    spread = (
        F.col("radius") * F.col("bnorm") + F.col(bound_radius) * F.col("norm") + F.col("radius") * F.col(bound_radius)
    ) + F.lit(1e-9) * (F.col("norm") + F.col("radius") + 1) * (F.col("bnorm") + F.col(bound_radius) + 1)
    upper, lower = F.col("dot") + spread, F.col("dot") - spread
    unknown = F.isnan(spread) | F.isnan("dot")
    high_enough = (upper >= F.col("least")) | (F.col("least") == LEAST)
    return unknown | (high_enough & ((lower <= F.col("most")) | (F.col("most") == MOST)))


def _searched(pairs: DataFrame, groups: DataFrame, blocks: DataFrame, chunks: int, kernel: Kernel, k: int, rule: str) -> DataFrame:
    """What the groups find in the blocks they are paired with, by (group, block)."""
    dealt = pairs.withColumn("chunk", F.pmod(F.xxhash64("block"), F.lit(chunks)))
    theirs = dealt.join(blocks.drop("cell", "bucket", "radius"), F.col("block") == F.col("node")).drop("node")
    own = dealt.select("group", "chunk").distinct().join(groups, F.col("group") == F.col("node")).select(
        F.col("group").alias("own_group"), F.col("chunk").alias("own_chunk"), "dim", "members", "vectors", "nodes",
        "radii", "asked",
    )

    def search(blocks: pa.Table, group: pa.Table) -> pa.Table:
        group = group.combine_chunks().to_batches()[0]
        at = {name: group.column(name)[0] for name in group.schema.names}
        dim = at["dim"].as_py()
        found = Found(Side(at, dim), at["asked"].as_py(), k, rule)
        for batch in blocks.to_batches():
            for n in range(batch.num_rows):
                kernel(found, Side({c: batch.column(c)[n] for c in ("members", "vectors", "nodes", "radii")}, dim))
        return found.table()

    return theirs.groupBy("group", "chunk").cogroup(own.groupBy("own_group", "own_chunk")).applyInArrow(search, _FOUND)


def search(
    space: Workspace, groups: DataFrame, blocks: DataFrame, net: Net, windows: DataFrame, kernel: Kernel,
    k: int, rule: str = "any",
) -> DataFrame:
    """(row, id, window, rank, score, hit_id, hit_row): the best ``k`` of every window of the grouped queries.

    ``windows`` are (row, window, low, high). Best is the highest score, then the lowest id.
    """
    side = ["dim", "bucket"] if rule == "same" else ["dim"]
    cells = _cell_pairs(space, net, blocks)
    summary = blocks.select("dim", "bucket", F.col("cell").alias("bcell"), F.col("radius").alias("bradius"), F.col("node").alias("block"))
    chunks = max(1, -(-summary.count() // CHUNK))
    queries = groups.select("node", F.explode("members.row").alias("row"))

    def asking(windows: DataFrame) -> DataFrame:
        one = F.struct("row", "window", "low", "high")
        asked = queries.join(windows, "row").groupBy("node").agg(
            F.collect_list(one).alias("asked"), F.min("low").alias("least"), F.max("high").alias("most")
        )
        return groups.join(asked, "node")

    home_side = [*side, "bcell"]
    homes = summary.groupBy(*home_side).agg(F.array_distinct(F.array(F.min("block"), F.max("block"))).alias("blocks"))
    first = asking(windows)
    at_home = first.withColumn("bcell", F.col("cell")).join(homes, home_side).select(
        F.col("node").alias("group"), F.explode("blocks").alias("block")
    )
    at_home = space.pin(at_home, "home-pairs")
    started = space.pin(_searched(at_home, first, blocks, chunks, kernel, k, rule), "home")

    # Two home blocks may be searched apart: then a window has up to twice k finds, the kth is not the worst.
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"))
    reached = started.withColumn("at", F.row_number().over(order)).filter(F.col("at") == k).select(
        "row", "window", F.col("score").alias("kth")
    )
    raised = space.pin(windows.join(reached, ["row", "window"], "left").select(
        "row", "window", F.greatest("low", F.coalesce("kth", "low")).alias("low"), "high"
    ), "windows")
    second = asking(raised)
    reach = summary.groupBy(*side, "bcell").agg(F.max("bradius").alias("cell_radius"))
    near_cells = second.drop("members", "vectors", "nodes", "radii", "asked").join(cells, ["dim", "cell"]).join(
        reach, [*side, "bcell"]
    ).filter(_within("cell_radius"))
    pairs = near_cells.join(summary if rule == "same" else summary.drop("bucket"), [*side, "bcell"]).filter(
        _within("bradius")
    ).select(F.col("node").alias("group"), "block")
    rest = space.pin(pairs.join(at_home, ["group", "block"], "left_anti"), "pairs")
    others = space.pin(_searched(rest, second, blocks, chunks, kernel, k, rule), "others")
    best = Window.partitionBy("row", "window").orderBy(F.desc("score"), "hit_id", "hit_row")
    return started.union(others).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

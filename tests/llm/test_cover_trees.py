"""Operators 12 and 13 against brute force, their trees' invariants and edge cases."""

import numpy as np
import pytest

from tallyloom.llm import cover_forest, cover_tree, exact_top_k
from tallyloom.llm import hard_negatives as hard_negatives_module
from tallyloom.llm.cover_forest import LEAST, MOST, Found, Side
from tallyloom.llm.cover_tree import BASE, grow, integers, product_bounds, scores
from tallyloom.llm.exact_top_k import dual_descent, top_scores
from tallyloom.llm.hard_negatives import best_first, hard_negatives

KINDS = "vec_id bigint, embedding array<float>, label int, score bigint, row string, node int, `rank` int"
INF = float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, g, 1, "x", 0, None) for i, v, g in rows], KINDS).repartition(3)


def clouds(seed, n, dim=8, spread=0.3):
    """Clusters of unlike width, with copies and scaled copies."""
    rng = np.random.default_rng(seed)
    heads = rng.standard_normal((6, dim))
    vectors = heads[rng.integers(0, 6, n)] + spread * rng.standard_normal((n, dim)) * rng.random((n, 1))
    vectors[n // 2 : n // 2 + n // 10] = vectors[0]
    vectors[-n // 10 :] *= rng.random((n // 10, 1)) * 3
    return [(i, v.astype(np.float32).tolist(), int(rng.integers(0, 4))) for i, v in enumerate(vectors)]


def usable(rows, labelled=False):
    return [
        (i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v], g) for i, v, g in rows
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and (g is not None or not labelled)
    ]


def ranked(rows, at, fits):
    """(score, id) of all rows but ``at`` that fit, best first."""
    _, x, label = rows[at]
    found = [
        (sum(a * b for a, b in zip(x, y)), i) for n, (i, y, g) in enumerate(rows)
        if n != at and len(x) == len(y) and fits(g, label)
    ]
    return sorted(found, key=lambda s: (-s[0], s[1]))


def brute_top(rows, k=5):
    rows = usable(rows)
    return sorted(
        (i, n + 1, j, s) for at, (i, _, _) in enumerate(rows) if i % 50 == 0
        for n, (s, j) in enumerate(ranked(rows, at, lambda g, own: True)[:k])
    )


def brute_negatives(rows):
    rows = usable(rows, labelled=True)
    found = []
    for at, (i, _, _) in enumerate(rows):
        if i % 50 == 0:
            others = ranked(rows, at, lambda g, own: g != own)
            for p, j in ranked(rows, at, lambda g, own: g == own)[:5]:
                fit = [(s, m) for s, m in others if 50 * p <= 100 * s <= 95 * p][:3]
                found += [(i, j, n + 1, m, p, s) for n, (s, m) in enumerate(fit)]
    return sorted(found)


def told(result, *columns):
    return sorted(tuple(r[c] for c in columns) for r in result.collect())


TOP = ("query_id", "rank", "vec_id", "score")
NEGATIVES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

EDGES = [
    (0, [1.0, 2.0], 1), (50, [1.0, 2.0], 1), (50, [1.0, 2.0], 1), (100, [-1.0, 0.5], 2), (7, [0.5, 0.5], 2),
    (8, [0.5, 0.5], 2), (9, [1.5, 0.25], None), (10, None, 1), (11, [1.0, None], 1), (12, [INF, 1.0], 1),
    (13, [float("nan"), 1.0], 2), (14, [], 1), (150, [], 2), (15, [0.0, 0.0], 3), (None, [3.0, 3.0], 3),
    (200, [1.0, 2.0, 3.0], 1), (16, [1.0, 2.0, 2.5], 2), (17, [1.0, 1.5, 2.0], 1), (-50, [0.25, 1.0], 3),
]


def test_edges(spark):
    assert told(top_scores(frame(spark, EDGES)), *TOP) == brute_top(EDGES)
    assert told(hard_negatives(frame(spark, EDGES)), *NEGATIVES) == brute_negatives(EDGES)
    none = frame(spark, [])
    assert top_scores(none).columns == [*TOP] and top_scores(none).count() == 0
    assert hard_negatives(none).columns == [*NEGATIVES] and hard_negatives(none).count() == 0
    # Queries without any candidate of their length or label.
    assert told(top_scores(frame(spark, [(0, [1.0], 1)])), *TOP) == []
    assert told(hard_negatives(frame(spark, [(0, [1.0], 1), (1, [1.0], 1)])), *NEGATIVES) == []


@pytest.mark.parametrize("label_share", [None, 0.6])
def test_against_brute_force_in_small_blocks(spark, monkeypatch, label_share):
    """Many blocks, cells and groups; with a hot label and cell that hold most rows."""
    for module in (exact_top_k, hard_negatives_module):
        monkeypatch.setattr(module, "BLOCK_ROWS", 40)
        monkeypatch.setattr(module, "GROUP_ROWS", 2)
    monkeypatch.setattr(cover_forest, "CHUNK", 3)
    rows = clouds(3, 450)
    if label_share:
        rows = [(i, v if i % 3 else [1.0] * 8, 1 if i % 10 < 10 * label_share else g) for i, v, g in rows]
    assert told(top_scores(frame(spark, rows)), *TOP) == brute_top(rows)
    assert told(hard_negatives(frame(spark, rows)), *NEGATIVES) == brute_negatives(rows)


def test_large_components(spark):
    rows = [(50 * n, [float(np.float32(x)) for x in v], n % 2) for n, v in enumerate(
        [[1e30, 1.0], [1e30, -1.0], [2e9, 1.0], [2e9, 3.0], [-1e30, 5.0], [0.5, 2.0]])]
    low, high = -(2**63), 2**63 - 1
    wanted = [(i, n, j, min(max(s, low), high)) for i, n, j, s in brute_top(rows)]
    # Scores beyond a long tie, and ties go by id.
    got = told(top_scores(frame(spark, rows)), *TOP)
    assert [(i, s) for i, _, _, s in got] == [(i, s) for i, _, _, s in wanted]


def test_tree_invariants(monkeypatch):
    monkeypatch.setattr(cover_tree, "ALONE", 3)
    for seed in range(5):
        points = integers(np.array([v for _, v, _ in clouds(seed, 600)]))
        order, tree = grow(points, leaf=8)
        assert sorted(order) == list(range(len(points))) and (points[order] == tree.points).all()
        lifted, top = cover_tree.lift(tree.points)
        assert np.allclose((lifted**2).sum(axis=1), top)
        covered = np.zeros(len(points), int)
        for n in range(len(tree.radius)):
            below = lifted[tree.start[n] : tree.stop[n]]
            assert np.sqrt(((below - tree.centres[n]) ** 2).sum(axis=1)).max() <= tree.radius[n] + 1e-6
            if tree.leaf(n):
                covered[tree.start[n] : tree.stop[n]] += 1
                continue
            kids = list(tree.below(n))
            assert tree.start[kids[0]] == tree.start[n] and tree.stop[kids[-1]] == tree.stop[n]
            scale = BASE ** (np.ceil(np.log(tree.radius[n]) / np.log(BASE)) - 1)
            heads = np.unique([tuple(tree.centres[c]) for c in kids], axis=0)
            apart = np.sqrt(((heads[:, None] - heads[None]) ** 2).sum(axis=-1))
            assert (apart[~np.eye(len(heads), dtype=bool)] > scale / BASE - 1e-6).all()
        assert (covered == 1).all()
        queries = points[::7]
        low, high = product_bounds(tree, queries)
        exact = scores(queries, tree.points)
        for n in range(len(tree.radius)):
            own = exact[:, tree.start[n] : tree.stop[n]]
            assert (low[:, n] <= own.min(axis=1)).all() and (own.max(axis=1) <= high[:, n]).all()


def test_nodes_out_of_reach_are_skipped():
    """On clustered vectors most points are never compared."""
    rng = np.random.default_rng(1)
    heads = rng.standard_normal((40, 16))
    points = integers((heads[:, None] + 0.01 * rng.standard_normal((40, 50, 16))).reshape(-1, 16))

    def side(points):
        order, tree = grow(points, leaf=32)
        made = Side.__new__(Side)
        made.tree, made.row, made.id, made.label = tree, order, order, [None] * len(order)
        return made

    data, queries = side(points), side(points[::100])
    for kernel in (dual_descent, best_first):
        found = Found(queries, [dict(row=int(r), window=0, low=LEAST, high=MOST) for r in queries.row], 5, "any")
        compared, offer = [], found.offer
        found.offer = lambda at, block, start, stop: (compared.append(len(at) * (stop - start)), offer(at, block, start, stop))
        kernel(found, data)
        assert 0 < sum(compared) < 0.5 * len(points) * len(queries.row), kernel

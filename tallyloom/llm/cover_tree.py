"""Cover trees over blocks of integer vectors, and bounds on the inner products below their nodes.

A block has a bounded number of points. Each is augmented by one component that makes all norms of the block
equal, so that for a query q with zero there |q - x|^2 = |q|^2 + top - 2<q, x>: a bound on distances bounds
inner products. Nodes nest: a node's centre is also that of its first child. The centres of a node's children
are more than a power of ``BASE`` apart, the level's scale, and no point is farther than it from its child's centre;
``radius`` is the largest real distance below a node. Children of a few points, as most are where the scale
falls below the usual distance of the data, become leaves around their parent's centre, in rings by distance.
"""

from __future__ import annotations

import math

import numpy as np

BASE = 1.3
LEAF = 256
#: Children of fewer points join the rings.
ALONE = 32
#: Sums below are exact as doubles.
EXACT = 2.0**53
_LOW, _HIGH = -(2**63), 2**63 - 1


def integers(vectors: np.ndarray, factor: float = 256.0) -> np.ndarray:
    """floor(factor * x) of every component, as doubles."""
    top = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.clip(np.floor(factor * vectors), -top, top)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors as longs, exact; those beyond a long stop at its ends."""
    most = max(1.0, np.abs(a).max(initial=0)) * max(1.0, np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in side] for side in (a, b)]
    found = [[min(max(sum(map(int.__mul__, x, y)), _LOW), _HIGH) for y in whole[1]] for x in whole[0]]
    return np.array(found, np.int64).reshape(len(a), len(b))


def _away(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        found = np.sqrt(np.square(points - centre).sum(axis=1))
    return np.where(np.isnan(found), np.inf, found)


class CoverTree:
    """Node n holds ``points`` start[n] to stop[n]; its children are the nodes from first[n] on, none for a leaf.

    ``nodes`` has a row (start, stop, first child, children, place of the centre) for each.
    """

    def __init__(self, points: np.ndarray, nodes: np.ndarray, radius: np.ndarray):
        self.points, self.nodes, self.radius = points, nodes, radius
        self.start, self.stop, self.first, self.children, centre = nodes.T
        lifted, self.top = lift(points)
        self.centres = lifted[centre]

    def leaf(self, node: int) -> bool:
        return self.children[node] == 0

    def below(self, node: int) -> range:
        return range(self.first[node], self.first[node] + self.children[node])


def lift(points: np.ndarray) -> tuple[np.ndarray, float]:
    """The points with the component that makes their norms equal, and their squared norm then."""
    with np.errstate(over="ignore", invalid="ignore"):
        squares = np.square(points).sum(axis=1)
        top = float(squares.max(initial=0))
        added = np.sqrt(np.clip(top - squares, 0, None))
    return np.column_stack([points, np.where(np.isnan(added), 0, added)]), top


def grow(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, CoverTree]:
    """The tree over ``points``, whose own points are ``points`` in the order returned with it."""
    lifted, _ = lift(points)
    order = np.arange(len(points))
    nodes: list[list] = []
    radii: list[float] = []
    waiting: list[int] = []

    def add(start: int, members: np.ndarray, centre: int, split: bool = True) -> None:
        order[start : start + len(members)] = members
        radii.append(float(_away(lifted[members], lifted[centre]).max()))
        nodes.append([start, start + len(members), 0, 0, centre])
        if split and len(members) > leaf and 0 < radii[-1] < np.inf:
            waiting.append(len(nodes) - 1)

    if len(points):
        # The root's centre is the point nearest to the mean: any would do, this one has a small radius.
        with np.errstate(over="ignore", invalid="ignore"):
            middle = lifted.mean(axis=0)
        add(0, order.copy(), int(_away(lifted, middle).argmin()))
    while waiting:
        node = waiting.pop()
        start, stop, _, _, centre = nodes[node]
        children, alone = _cover(lifted, order[start:stop].copy(), centre, radii[node])
        nodes[node][2] = len(nodes)
        for head, members in children:
            add(start, members, head)
            start += len(members)
        alone = alone[np.argsort(_away(lifted[alone], lifted[centre]), kind="stable")]
        for ring in (alone[at : at + leaf] for at in range(0, len(alone), leaf)):
            add(start, ring, centre, split=False)
            start += len(ring)
        nodes[node][3] = len(nodes) - nodes[node][2]
    place = np.empty(len(points), np.int64)
    place[order] = np.arange(len(points))
    table = np.array(nodes, np.int64).reshape(-1, 5)
    table[:, 4] = place[table[:, 4]]
    return order, CoverTree(points[order], table, np.array(radii))


def _cover(points: np.ndarray, members: np.ndarray, centre: int, radius: float):
    """Children (centre, members) of a node and the points of children too small to be one."""
    scale = BASE ** (math.ceil(math.log(radius, BASE)) - 1)
    apart = _away(points[members], points[centre])
    if apart.max() <= scale:  # the logarithm was rounded up
        scale /= BASE
    near = apart <= scale
    children, alone = [(centre, members[near])], []
    rest = members[~near]
    x = points[rest]
    squares = np.square(x).sum(axis=1)
    # Rounding here only shifts points between children; their radii are measured.
    close = squares[:, None] + squares[None, :] - 2 * (x @ x.T) <= scale * scale
    np.fill_diagonal(close, True)
    free = np.ones(len(rest), bool)
    while free.any():
        head = int(free.argmax())
        own = close[head] & free
        free &= ~own
        if own.sum() < ALONE:
            alone.append(rest[own])
        else:
            children.append((rest[head], rest[own]))
    if len(children[0][1]) < ALONE and len(children) + len(alone) > 1:
        alone.append(children.pop(0)[1])
    return children, np.concatenate(alone) if alone else rest[:0]


def group_bounds(
    tree: CoverTree, centres: np.ndarray, radii: np.ndarray, squares: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of any query of a group with a point below each node.

    Groups of queries have ``centres``, without the added component, and ``radii``; ``squares`` are the
    least and the largest squared norm of the queries of each.
    """
    least, most = squares
    with np.errstate(over="ignore", invalid="ignore"):
        around = np.square(centres).sum(axis=1)[:, None] + tree.top
        apart = around - 2 * (centres @ tree.centres[:, :-1].T)
        slack = 1e-12 * (around + 1)  # rounding is some 10^-15 of the squares
        reach = radii[:, None] + tree.radius[None, :]
        nearest = np.maximum(np.sqrt(np.maximum(apart - slack, 0)) - reach, 0)
        farthest = np.sqrt(np.maximum(apart, 0) + slack) + reach
        upper = (most[:, None] + tree.top - nearest**2) / 2 + slack
        lower = (least[:, None] + tree.top - farthest**2) / 2 - slack
    return np.where(np.isnan(lower), -np.inf, lower), np.where(np.isnan(upper), np.inf, upper)


def product_bounds(tree: CoverTree, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for single queries."""
    with np.errstate(over="ignore"):
        squares = np.square(queries).sum(axis=1)
    return group_bounds(tree, queries, np.zeros(len(queries)), (squares, squares))

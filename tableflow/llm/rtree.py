"""An R-tree over count vectors, joined with another under a bound on the overlap of their sets.

A point counts a set's members by group. Two sets share at most the sum of the lesser counts, and
the sets below two nodes at most that of the nodes' upper corners. A pair of nodes is left where
this sum, or the sizes, rule out the wanted similarity, or where all below is linked already.
"""

from __future__ import annotations

import numpy as np

FAN = 8
PAIRS = 1 << 13
CELLS = 1 << 23  # counts of point pairs compared at a time


def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of two sets of ``sizes`` members in all that makes them similar."""
    return -(-percent * sizes // (100 + percent))


def _order(points: np.ndarray) -> np.ndarray:
    """Points in tree order: halves by the widest coordinate, down to one leaf."""
    done, stack = [], [np.arange(len(points))]
    while stack:
        part = stack.pop()
        if len(part) <= FAN:
            done.append(part)
            continue
        widest = int(np.argmax(np.ptp(points[part], axis=0)))
        half = FAN * (-(-len(part) // FAN) // 2)
        split = part[np.argsort(points[part, widest], kind="stable")]
        stack += [split[half:], split[:half]]
    return np.concatenate(done) if done else np.zeros(0, np.int64)


def folded(points: np.ndarray) -> np.ndarray:
    """Counts of neighbouring groups added up: the fewer coordinates by which the tree is built."""
    few = min(max(points.shape[1] // 16, 16), 256, points.shape[1])
    return points.reshape(len(points), few, -1).sum(axis=2, dtype=np.int64)


class RTree:
    """Levels from the root to the points; a node covers ``FAN`` nodes in a row of the next level.

    Nodes have corners in few coordinates, points are compared in these first and then in all.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        few = folded(points)
        self.order = _order(few)
        self.points = points[self.order]
        level = (few[self.order], *(x[self.order] for x in (sizes, sizes, labels, labels)))
        self.levels = [level]
        while len(level[0]) > 1:
            starts = np.arange(0, len(level[0]), FAN)
            upper, least, most, low, high = level
            level = (np.maximum.reduceat(upper, starts), np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts),
                     np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts))
            self.levels.insert(0, level)

    def below(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many children each node has, and all of them in a row."""
        counts = np.minimum(FAN, len(self.levels[level + 1][0]) - nodes * FAN)
        ends = np.cumsum(counts)
        return counts, np.repeat(nodes * FAN - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def joined(one: RTree, other: RTree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of points that the bound leaves and that have different labels."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    root = np.zeros(1, np.int64)
    stack = [(0, 0, root, root)] if len(one.order) and len(other.order) else []
    while stack:
        a, b, i, j = stack.pop()
        if len(i) > PAIRS:
            stack += [(a, b, i[k:k + PAIRS], j[k:k + PAIRS]) for k in range(0, len(i), PAIRS)]
            continue
        (top, least, most, low, high), (top2, least2, most2, low2, high2) = one.levels[a], other.levels[b]
        keep = ((100 * most[i] >= percent * least2[j]) & (100 * most2[j] >= percent * least[i])
                & ~((low[i] == high[i]) & (low2[j] == high2[j]) & (low[i] == low2[j])))
        i, j = i[keep], j[keep]
        keep = np.minimum(top[i], top2[j]).sum(axis=1) >= needed(least[i] + least2[j], percent)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        deeper, deeper2 = a + 1 < len(one.levels), b + 1 < len(other.levels)
        if not deeper and not deeper2:
            step, least = max(1, CELLS // one.points.shape[1]), needed(least[i] + least2[j], percent)
            shared = [np.minimum(one.points[i[k:k + step]], other.points[j[k:k + step]]).sum(axis=1, dtype=np.int64) for k in range(0, len(i), step)]
            near = np.concatenate(shared) >= least
            found.append((one.order[i[near]], other.order[j[near]]))
            continue
        if deeper:
            counts, i = one.below(a, i)
            j = np.repeat(j, counts)
        if deeper2:
            counts, j = other.below(b, j)
            i = np.repeat(i, counts)
        stack.append((a + deeper, b + deeper2, i, j))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])

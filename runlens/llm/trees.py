"""Box trees over integer points in level order, and the dual traversal of two of them.

A tree cuts its points at the middle of their widest dimension until a node holds `leaf` points at most. Points are
kept in tree order: a node is a run of them, and level `l` has 2**l nodes that begin at n * i // 2**l. With leaves
of one point some nodes may be empty; they have the box of the next point and own nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def depth_of(n: int, leaf: int) -> int:
    depth = 0
    while n > leaf << depth:
        depth += 1
    return depth


def starts(n: int, level: int) -> np.ndarray:
    return n * np.arange((1 << level) + 1, dtype=np.int64) >> level


@dataclass
class Tree:
    """Points in tree order with their former places; boxes and sums of all nodes, level after level."""

    order: np.ndarray
    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray
    depth: int

    def level(self, values: np.ndarray, level: int) -> np.ndarray:
        return values[(1 << level) - 1 : (1 << level + 1) - 1]


def build(points: np.ndarray, leaf: int) -> Tree:
    n, depth = len(points), depth_of(len(points), leaf)
    order = np.arange(n)
    for level in range(depth):
        bounds, halves = starts(n, level), starts(n, level + 1)
        for i in range(1 << level):
            a, middle, b = bounds[i], halves[2 * i + 1], bounds[i + 1]
            if not a < middle < b:
                continue
            part = points[order[a:b]]
            widest = part[:, np.argmax(part.max(axis=0) - part.min(axis=0))]
            order[a:b] = order[a:b][np.argpartition(widest, middle - a)]
    points = points[order]
    each = [[f.reduceat(points, starts(n, level)[:-1], axis=0) for level in range(depth + 1)] for f in (np.minimum, np.maximum, np.add)]
    return Tree(order, points, *[np.concatenate(x) for x in each], depth)


def _bounds(p: Tree, p_level: int, e: Tree, e_level: int, nodes: np.ndarray, entries: np.ndarray):
    """Least and greatest squared distance between the boxes of node pairs."""
    low_p, high_p = (p.level(x, p_level)[nodes] for x in (p.low, p.high))
    low_e, high_e = (e.level(x, e_level)[entries] for x in (e.low, e.high))
    gap = np.maximum(np.maximum(low_e - high_p, low_p - high_e), 0)
    span = np.maximum(high_e - low_p, high_p - low_e)
    return np.einsum("ij,ij->i", gap, gap), np.einsum("ij,ij->i", span, span)


def nearest_nodes(points: Tree, entries: Tree):
    """Dual traversal: (level, node, entry) of point nodes that one entry owns whole, then the pairs of point
    leaves with entry leaves that stay uncertain.

    A pair goes when its least distance exceeds the least of the greatest distances of the point node; equal
    distances stay, so ties are decided among all entries that have them.
    """
    n_entries, p_level, e_level = len(entries.points), 0, 0
    nodes, others = np.zeros(1, np.int64), np.zeros(1, np.int64)
    owned = []
    while True:
        least, greatest = _bounds(points, p_level, entries, e_level, nodes, others)
        first = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
        runs = np.diff(np.append(first, len(nodes)))
        begins = starts(n_entries, e_level)
        sizes = np.diff(begins)[others]
        near = (least <= np.repeat(np.minimum.reduceat(greatest, first), runs)) & (sizes > 0)
        left = np.add.reduceat(np.where(near, sizes, 0), first)
        whole = near & np.repeat(left == 1, runs)
        owned.append((p_level, nodes[whole], entries.order[begins[others[whole]]]))
        on = near & ~whole
        nodes, others = nodes[on], others[on]
        if not len(nodes) or (p_level == points.depth and e_level == entries.depth):
            return owned, nodes, others
        if e_level < entries.depth:
            nodes, others = np.repeat(nodes, 2), (2 * others[:, None] + np.arange(2)).ravel()
            e_level += 1
        if p_level < points.depth:
            # Both halves of a node take over its whole run of entry nodes.
            nodes, others = np.concatenate([2 * nodes, 2 * nodes + 1]), np.tile(others, 2)
            sort = np.argsort(nodes, kind="stable")
            nodes, others = nodes[sort], others[sort]
            p_level += 1


def exact_type(points: np.ndarray, entries: np.ndarray):
    """Doubles where all sums of products stay below 2**53 and are exact, else 64-bit integers."""
    most = max([1, *(int(np.abs(x).max()) for x in (points, entries) if x.size)])
    return np.float64 if 4 * points.shape[1] * most * most < 1 << 53 else np.int64


def nearest(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The first of the nearest entries of every point, in exact integers; both have the type of `exact_type`."""
    if points.dtype == np.float64:
        # Without the square of the point, which is the same for all entries.
        return ((entries * entries).sum(axis=1) - 2 * (points @ entries.T)).argmin(axis=1)
    return np.stack([((points - one) ** 2).sum(axis=1) for one in entries], axis=1).argmin(axis=1)

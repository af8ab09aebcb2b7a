"""Histogram gradient-boosted trees in numpy, flattened into arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Forest:
    """All trees in one set of arrays; a leaf points to itself on both sides."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                below = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(below, self.left[node], self.right[node])
            total += self.value[node]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -40, 40)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    least: float = 2.0,
    smooth: float = 1.0,
) -> Forest:
    """Boosts the logistic loss on binned features, level by level.

    Without rows, or with one class alone, the forest has no trees and the smoothed
    share of label 1 as its score.
    """
    n, width = x.shape
    share = (y.sum() + 1.0) / (n + 2.0)
    base = float(np.log(share / (1 - share)))
    nodes: dict[str, list] = {"feature": [], "threshold": [], "left": [], "right": [], "value": []}
    roots: list[int] = []
    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(width)]
        binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], 1)
        raw = np.full(n, base)
        for _ in range(trees):
            p = 1.0 / (1.0 + np.exp(-raw))
            roots.append(_grow(nodes, binned, edges, p - y, p * (1 - p), depth, rate, least, smooth, raw))
    flat = {k: np.array(v, np.float64 if k in ("threshold", "value") else np.int64) for k, v in nodes.items()}
    return Forest(roots=np.array(roots, np.int64), depth=depth, base=base, **flat)


def _grow(nodes, binned, edges, gradient, hessian, depth, rate, least, smooth, raw) -> int:
    n, width = binned.shape

    def new_node() -> int:
        at = len(nodes["feature"])
        for name, value in (("feature", 0), ("threshold", 0.0), ("left", at), ("right", at), ("value", 0.0)):
            nodes[name].append(value)
        return at

    root = new_node()
    of_row = np.zeros(n, np.int64)  # place in ``level``, or -1 in a finished leaf
    level = [root]
    leaf_of = np.full(n, root)
    for step in range(depth + 1):
        live = np.flatnonzero(of_row >= 0)
        if not len(live):
            break
        k = len(level)
        slot = of_row[live]
        g_node = np.bincount(slot, gradient[live], k)
        h_node = np.bincount(slot, hessian[live], k)
        for i, node in enumerate(level):
            nodes["value"][node] = -rate * g_node[i] / (h_node[i] + smooth)
        if step == depth:
            break
        cell = (slot[:, None] * width + np.arange(width)) * BINS + binned[live]
        shape = (k, width, BINS)
        g = np.bincount(cell.ravel(), np.repeat(gradient[live], width), k * width * BINS).reshape(shape).cumsum(2)
        h = np.bincount(cell.ravel(), np.repeat(hessian[live], width), k * width * BINS).reshape(shape).cumsum(2)
        rest_g, rest_h = g_node[:, None, None] - g, h_node[:, None, None] - h
        gain = g**2 / (h + smooth) + rest_g**2 / (rest_h + smooth) - (g_node**2 / (h_node + smooth))[:, None, None]
        gain[(h < least) | (rest_h < least)] = -np.inf
        best = gain.reshape(k, -1).argmax(1)
        good = gain.reshape(k, -1)[np.arange(k), best] > 1e-6
        feature, cut = best // BINS, best % BINS
        next_level: list[int] = []
        goes = np.full((k, 2), -1)
        for i in np.flatnonzero(good):
            node = level[i]
            nodes["feature"][node] = int(feature[i])
            nodes["threshold"][node] = float(edges[feature[i]][cut[i]])
            nodes["left"][node], nodes["right"][node] = new_node(), new_node()
            goes[i] = len(next_level), len(next_level) + 1
            next_level += [nodes["left"][node], nodes["right"][node]]
        right = binned[live, feature[slot]] > cut[slot]
        of_row[live] = goes[slot, right.astype(int)]
        moved = live[of_row[live] >= 0]
        if len(next_level):
            leaf_of[moved] = np.array(next_level)[of_row[moved]]
        level = next_level
        if not level:
            break
    raw += np.array(nodes["value"])[leaf_of]
    return root

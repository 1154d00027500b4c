"""Gradient-boosted trees for small tables of numbers."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

DEPTH, ROUNDS, RATE, BINS, RIDGE, LEAST = 3, 60, 0.2, 24, 1.0, 4


@dataclass
class Trees:
    """Complete binary trees of ``DEPTH`` levels: columns and bounds of the inner nodes, leaf values."""

    base: float = 0.0
    columns: list[np.ndarray] = field(default_factory=list)
    bounds: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)
    scale: float = 1.0  # calibration: probability = sigmoid(scale * score + shift)
    shift: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for columns, bounds, leaves in zip(self.columns, self.bounds, self.leaves, strict=True):
            node = np.zeros(len(x), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, columns[node]] > bounds[node])
            out += leaves[node - len(columns)]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * self.scores(x) + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Logistic loss, second-order splits over quantile bins."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    trees = Trees(base=float(np.log(share / (1 - share))))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    score = np.full(len(x), trees.base)
    inner = 2**DEPTH - 1
    for _ in range(ROUNDS):
        p = _sigmoid(score)
        gradient, curve = y - p, p * (1 - p)
        columns, bounds = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(x), int)
        for one in range(inner):
            own = np.flatnonzero(node == one)
            split = _best_split(binned[own], gradient[own], curve[own], edges)
            if split:
                columns[one], bounds[one] = split
            node[own] = 2 * one + 1 + (x[own, columns[one]] > bounds[one])
        leaf = node - inner
        g, h = (np.bincount(leaf, v, 2**DEPTH) for v in (gradient, curve))
        values = RATE * g / (h + RIDGE)
        score += values[leaf]
        trees.columns.append(columns)
        trees.bounds.append(bounds)
        trees.leaves.append(values)
    return trees


def _best_split(binned: np.ndarray, g: np.ndarray, h: np.ndarray, edges: list[np.ndarray]):
    best, found = 1e-6, None
    if len(g) < 2 * LEAST:
        return None
    whole = g.sum() ** 2 / (h.sum() + RIDGE)
    for column, bounds in enumerate(edges):
        if not len(bounds):
            continue
        size = len(bounds) + 1
        n, gs, hs = (np.bincount(binned[:, column], w, size).cumsum()[:-1] for w in (None, g, h))
        gain = gs**2 / (hs + RIDGE) + (g.sum() - gs) ** 2 / (h.sum() - hs + RIDGE) - whole
        gain[(n < LEAST) | (len(g) - n < LEAST)] = 0
        if gain.max() > best:
            best, found = gain.max(), (column, bounds[gain.argmax()])
    return found


def calibrate(trees: Trees, x: np.ndarray, y: np.ndarray) -> None:
    """Platt scaling on rows the trees have not seen."""
    s = trees.scores(x)
    targets = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    z, w = np.column_stack([s, np.ones(len(s))]), np.array([1.0, 0.0])
    for _ in range(30):
        p = _sigmoid(z @ w)
        w += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2), z.T @ (targets - p))
    trees.scale, trees.shift = float(w[0]), float(w[1])

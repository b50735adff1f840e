"""Gradient-boosted trees for a 0/1 label over a bounded sample of dense rows,
kept as flat numpy node arrays and scored without a Python loop over rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """All trees in one set of node arrays.  A leaf points at itself, so walking
    `depth` steps from the roots ends in the leaves for every row at once."""
    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out += self.value[at]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def train(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2,
          bins: int = 48, min_rows: int = 8, ridge: float = 1.0,
          monotone: dict[int, int] | None = None, pseudo: tuple[float, float] = (0.5, 0.5)) -> Forest:
    """Second-order boosting of the logistic loss on quantile bins.

    `monotone` maps a feature to +1 (score may not fall as it rises) or -1.  A
    constrained split whose leaf values would be out of order is refused, and
    the values below it are kept on their side of the split's midpoint.
    Without rows of both labels the forest is the base rate alone, smoothed by
    `pseudo` rows of label 1 and of label 0.
    """
    n, width = x.shape if x.size else (len(y), 0)
    ones = float(y.sum())
    base = float(np.log((ones + pseudo[0]) / (n - ones + pseudo[1])))
    nodes: list[list] = []                       # feature, threshold, left, right, value
    roots: list[int] = []
    if width and 0 < ones < n:
        monotone = monotone or {}
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        margin = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
            roots.append(_grow(nodes, binned, cuts, grad, hess, np.arange(n), depth, min_rows, ridge,
                               monotone, -np.inf, np.inf, rate, margin))
    a = np.array(nodes, dtype=float).reshape(-1, 5)
    return Forest(base, np.array(roots, dtype=int), a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int),
                  a[:, 3].astype(int), a[:, 4], depth)


def _grow(nodes, binned, cuts, grad, hess, rows, depth, min_rows, ridge, monotone, low, high, rate, margin) -> int:
    me = len(nodes)
    g, h = grad[rows].sum(), hess[rows].sum()
    value = float(np.clip(-g / (h + ridge), low, high))
    nodes.append([0, 0.0, me, me, rate * value])
    best = None
    if depth and len(rows) >= 2 * min_rows:
        for f, edges in enumerate(cuts):
            if not len(edges):
                continue
            k = binned[rows, f]
            size = len(edges) + 1
            cg = np.cumsum(np.bincount(k, grad[rows], size))[:-1]
            ch = np.cumsum(np.bincount(k, hess[rows], size))[:-1]
            cn = np.cumsum(np.bincount(k, minlength=size))[:-1]
            lv = np.clip(-cg / (ch + ridge), low, high)
            rv = np.clip(-(g - cg) / (h - ch + ridge), low, high)
            gain = cg**2 / (ch + ridge) + (g - cg)**2 / (h - ch + ridge) - g**2 / (h + ridge)
            ok = (cn >= min_rows) & (len(rows) - cn >= min_rows)
            if f in monotone:
                ok &= monotone[f] * (rv - lv) >= 0
            if ok.any():
                j = int(np.argmax(np.where(ok, gain, -np.inf)))
                if gain[j] > 1e-6 and (best is None or gain[j] > best[0]):
                    best = (gain[j], f, j, lv[j], rv[j])
    if best is None:
        margin[rows] += rate * value
        return me
    _, f, j, lv, rv = best
    inside = binned[rows, f] <= j
    bounds = [(low, high), (low, high)]
    if f in monotone:
        middle = (lv + rv) / 2
        bounds = [(low, middle), (middle, high)] if monotone[f] > 0 else [(middle, high), (low, middle)]
    kids = [_grow(nodes, binned, cuts, grad, hess, part, depth - 1, min_rows, ridge, monotone, *b, rate, margin)
            for part, b in zip((rows[inside], rows[~inside]), bounds)]
    nodes[me] = [f, float(cuts[f][j]), *kids, 0.0]
    return me

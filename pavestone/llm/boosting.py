"""Gradient-boosted trees for a binary target, in numpy: small enough to travel to every task."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Complete trees of a fixed depth over quantile bins, logistic loss."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 1.0) -> None:
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge
        self.feature = self.cut = self.value = None
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, m = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1], method="inverted_cdf")) for j in range(m)]
        binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(m)], 1)
        inner, leaves = (1 << self.depth) - 1, 1 << self.depth
        self.feature = np.zeros((self.trees, inner), np.int64)
        self.cut = np.full((self.trees, inner), np.inf)
        self.value = np.zeros((self.trees, leaves))
        rate = y.mean()
        self.base = float(np.log(rate / (1 - rate)))
        score = np.full(n, self.base)
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            node = np.zeros(n, np.int64)
            for d in range(self.depth):
                at, wide = (1 << d) - 1, self.bins
                key = (node - at) * wide
                gain = np.full((1 << d, m, wide), -np.inf)
                for j in range(m):
                    gs = np.bincount(key + binned[:, j], g, (1 << d) * wide).reshape(-1, wide).cumsum(1)
                    hs = np.bincount(key + binned[:, j], h, (1 << d) * wide).reshape(-1, wide).cumsum(1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain[:, j] = gs**2 / (hs + self.ridge) + (gt - gs) ** 2 / (ht - hs + self.ridge) - gt**2 / (ht + self.ridge)
                    gain[:, j, len(edges[j]) :] = -np.inf
                best = gain.reshape(1 << d, -1).argmax(1)
                feature, bin_ = best // wide, best % wide
                useful = gain.reshape(1 << d, -1).max(1) > 1e-6
                for k in range(1 << d):
                    if useful[k]:
                        self.feature[t, at + k], self.cut[t, at + k] = feature[k], edges[feature[k]][bin_[k]]
                right = x[np.arange(n), self.feature[t, node]] > self.cut[t, node]
                node = 2 * node + 1 + right
            leaf = node - inner
            gs, hs = np.bincount(leaf, g, leaves), np.bincount(leaf, h, leaves)
            self.value[t] = self.rate * gs / (hs + self.ridge)
            score += self.value[t][leaf]
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, self.feature[t, node]] > self.cut[t, node])
            out += self.value[t][node - ((1 << self.depth) - 1)]
        return out

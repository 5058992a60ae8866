"""Histogram gradient-boosted trees for two classes, trained with numpy, kept as flat arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Complete binary trees of one depth. `feature` and `threshold` hold a tree's inner nodes by level, `leaf` its leaves."""

    prior: float
    depth: int
    feature: np.ndarray  # trees x (2^depth - 1)
    threshold: np.ndarray  # as feature; goes right if the value is greater
    leaf: np.ndarray  # trees x 2^depth

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row: all trees descend one level at a time."""
        trees = np.arange(len(self.leaf))[None, :]
        node = np.zeros((len(x), len(self.leaf)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        total = self.prior + self.leaf[trees, node - (2**self.depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0
) -> Forest:
    """Boost trees on the logistic loss. Features are cut at quantiles; splits maximise the gain over histograms of gradients.

    Without rows, or with one class only, the forest has no trees and scores the smoothed share of label 1.
    """
    n, k = x.shape
    share = (y.sum() + 1) / (n + 2)
    prior = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if n == 0 or y.min() == y.max():
        trees = 0
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    if trees == 0:
        return Forest(prior, depth, feature, threshold, leaf)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(k)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(k)], axis=1)
    total = np.full(n, prior)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)  # within its level
        for level in range(depth):
            width = 2**level
            best = np.full(width, 1e-6)
            for j in range(k):
                at = node * bins + binned[:, j]
                gl = np.bincount(at, g, width * bins).reshape(width, bins).cumsum(axis=1)
                hl = np.bincount(at, h, width * bins).reshape(width, bins).cumsum(axis=1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[:, len(edges[j]) :] = 0
                gain[(hl < 1) | (ht - hl < 1)] = 0
                cut = gain.argmax(axis=1)
                for i in np.flatnonzero(gain[np.arange(width), cut] > best):
                    best[i] = gain[i, cut[i]]
                    feature[t, width - 1 + i] = j
                    threshold[t, width - 1 + i] = edges[j][cut[i]]
            f, cut = feature[t, width - 1 + node], threshold[t, width - 1 + node]
            node = 2 * node + (x[np.arange(n), f] > cut)
        gs, hs = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
        leaf[t] = -rate * gs / (hs + l2)
        total += leaf[t][node]
    return Forest(prior, depth, feature, threshold, leaf)

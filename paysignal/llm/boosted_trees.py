"""Gradient-boosted trees for a yes/no target, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class BoostedTrees:
    """Complete trees of one depth: feature and cut of every inner node, value of every leaf (log-odds steps)."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += value[at - inner]
        return out


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 50, depth: int = 4, rate: float = 0.25, penalty: float = 2.0,
    least_weight: float = 3.0,
) -> BoostedTrees:
    """Newton boosting of the logistic loss; cuts lie at quantiles of the training values."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(width)], axis=1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    score = np.full(n, base)
    inner, leaves = 2**depth - 1, 2**depth
    features = np.zeros((trees, inner), dtype=np.int64)
    cuts = np.full((trees, inner), np.inf)
    values = np.zeros((trees, leaves))
    for t in range(trees):
        chance = 1 / (1 + np.exp(-score))
        gradient, weight = y - chance, np.maximum(chance * (1 - chance), 1e-6)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-6)
            for j in range(width):
                key = (at - first) * BINS + binned[:, j]
                g = np.bincount(key, gradient, minlength=count * BINS).reshape(count, BINS).cumsum(axis=1)
                h = np.bincount(key, weight, minlength=count * BINS).reshape(count, BINS).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + penalty) + (all_g - g) ** 2 / (all_h - h + penalty) - all_g**2 / (all_h + penalty)
                gain[(h < least_weight) | (all_h - h < least_weight)] = 0
                gain = gain[:, : len(edges[j])]
                if not gain.shape[1]:
                    continue
                top = gain.argmax(axis=1)
                better = gain[np.arange(count), top] > best
                best[better] = gain[np.arange(count), top][better]
                features[t, first : first + count][better] = j
                cuts[t, first : first + count][better] = edges[j][top[better]]
            at = 2 * at + 1 + (x[np.arange(n), features[t, at]] > cuts[t, at])
        leaf = at - inner
        g, h = np.bincount(leaf, gradient, minlength=leaves), np.bincount(leaf, weight, minlength=leaves)
        values[t] = rate * g / (h + penalty)
        score += values[t, leaf]
    return BoostedTrees(features, cuts, values, base)

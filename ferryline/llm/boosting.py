"""Gradient-boosted trees for two classes, small enough to send anywhere."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth: per tree the inner nodes' feature
    and threshold (level by level) and the leaves' values."""

    base: float
    features: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of the positive class for each row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaves.shape[1]))
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - (2**depth - 1)]
        return out


def fit(
    x: np.ndarray,
    y: np.ndarray,
    weight: np.ndarray,
    rounds: int = 40,
    depth: int = 4,
    rate: float = 0.3,
    bins: int = 32,
) -> Trees:
    """Newton boosting of the logistic loss on binned features."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    base = float(np.log((weight * y).sum() / (weight * (1 - y)).sum()))
    margin = np.full(n, base)
    inner, cell = 2**depth - 1, width * bins
    place = binned + np.arange(width) * bins
    features = np.zeros((rounds, inner), np.int64)
    thresholds = np.full((rounds, inner), np.inf)
    leaves = np.zeros((rounds, 2**depth))
    ridge = 1.0
    for r in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(n, np.int64)  # within its level
        for level in range(depth):
            size = 2**level
            at = (node[:, None] * cell + place).ravel()
            g = np.bincount(at, np.repeat(grad, width), size * cell).reshape(size, width, bins).cumsum(2)
            h = np.bincount(at, np.repeat(hess, width), size * cell).reshape(size, width, bins).cumsum(2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < 1e-3) | (all_h - h < 1e-3)] = 0
            best = gain.reshape(size, -1).argmax(1)
            feature, split = np.divmod(best, bins)
            for k in range(size):
                if gain[k, feature[k], split[k]] > 1e-6:
                    features[r, size - 1 + k] = feature[k]
                    own = cuts[feature[k]]
                    thresholds[r, size - 1 + k] = own[split[k]] if split[k] < len(own) else np.inf
            own = size - 1 + node
            node = 2 * node + (x[np.arange(n), features[r, own]] > thresholds[r, own])
        g, h = np.bincount(node, grad, 2**depth), np.bincount(node, hess, 2**depth)
        leaves[r] = -rate * g / (h + ridge)
        margin += leaves[r][node]
    return Trees(base, features, thresholds, leaves)

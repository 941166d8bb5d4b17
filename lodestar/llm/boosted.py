"""Gradient-boosted trees for a binary label, over binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class BoostedTrees:
    """Complete binary trees of one depth; leaves hold log-odds."""

    start: float
    feature: np.ndarray  # tree x inner node
    threshold: np.ndarray  # tree x inner node; a value above it goes right
    leaf: np.ndarray  # tree x leaf

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        depth = self.leaf.shape[1].bit_length() - 1
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += leaf[at - len(feature)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32, l2: float = 1.0) -> BoostedTrees:
    """Newton boosting of the logistic loss; splits by binned gain, level by level.

    A matrix says which row lies above which cut of which feature, so that the sums
    over the rows right of every possible split of a level are one product.
    """
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    owner, cut = np.repeat(np.arange(len(cuts)), [len(c) for c in cuts]), np.concatenate(cuts)
    above = (x[:, owner] > cut).astype(np.float32).T
    base = float(np.average(y, weights=weight))
    start = float(np.log(base / (1 - base)))
    score = np.full(len(x), start)
    inner = (1 << depth) - 1
    features, thresholds, leaves = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, 1 << depth))
    rows = np.arange(len(x))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = (p - y) * weight, p * (1 - p) * weight
        at = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            own = at - first
            sums = np.zeros((len(x), 2 * width), np.float32)
            sums[rows, own], sums[rows, width + own] = g, h
            right = (above @ sums).astype(np.float64)
            right_g, right_h = right[:, :width], right[:, width:]
            total_g, total_h = np.bincount(own, g, width), np.bincount(own, h, width)
            left_g, left_h = total_g - right_g, np.maximum(total_h - right_h, 0)
            gains = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - total_g**2 / (total_h + l2)
            best = gains.argmax(axis=0)
            better = gains[best, np.arange(width)] > 1e-9
            features[t, first : first + width][better] = owner[best[better]]
            thresholds[t, first : first + width][better] = cut[best[better]]
            at = 2 * at + 1 + (x[rows, features[t, at]] > thresholds[t, at])
        own = at - inner
        leaves[t] = -rate * np.bincount(own, g, 1 << depth) / (np.bincount(own, h, 1 << depth) + l2)
        score += leaves[t][own]
    return BoostedTrees(start, features, thresholds, leaves)

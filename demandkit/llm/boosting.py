"""Gradient-boosted trees of fixed depth for two classes, on features cut into bins."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class BoostedTrees:
    """``cuts[f]`` are the bin edges of feature f; a tree is a complete one, in heap order."""

    cuts: list[np.ndarray]
    base: float
    features: np.ndarray  # trees x inner nodes
    above: np.ndarray  # a row goes right if its bin is larger than this
    leaves: np.ndarray  # trees x leaves

    def binned(self, x: np.ndarray) -> np.ndarray:
        made = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)]
        return np.stack(made, axis=1).astype(np.uint8) if len(x) else np.zeros(x.shape, np.uint8)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of class 1."""
        bins, rows = self.binned(x), np.arange(len(x))
        total, inner = np.full(len(x), self.base), self.features.shape[1]
        for feature, above, leaves in zip(self.features, self.above, self.leaves):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:  # all rows are on the same level
                at = 2 * at + 1 + (bins[rows, feature[at]] > above[at])
            total += leaves[at - inner] if len(at) else 0
        return total


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, leaf: float = 1.0) -> BoostedTrees:
    """Boosting with second-order leaf values; ``leaf`` is the penalty on a leaf's value."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    inner = (1 << depth) - 1
    model = BoostedTrees(cuts, float(np.log(share / (1 - share))), np.zeros((0, inner), int), np.zeros((0, inner), int), np.zeros((0, inner + 1)))
    bins = model.binned(x)
    score = np.full(len(y), model.base)
    made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(trees):
        p = _logistic(score)
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        feature, above, at = np.zeros(inner, int), np.full(inner, BINS), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n = (1 << level) - 1, 1 << level
            best = np.full(n, 1e-6)
            place = (at - first) * BINS
            for f in range(x.shape[1]):
                cell = place + bins[:, f]
                sums = [np.bincount(cell, w, n * BINS).reshape(n, BINS).cumsum(axis=1) for w in (g, h)]
                (gl, gt), (hl, ht) = [(s, s[:, -1:]) for s in sums]
                gain = gl**2 / (hl + leaf) + (gt - gl) ** 2 / (ht - hl + leaf) - gt**2 / (ht + leaf)
                cut = gain.argmax(axis=1)
                gain = gain[np.arange(n), cut]
                better = gain > best
                best[better] = gain[better]
                feature[first : first + n][better] = f
                above[first : first + n][better] = cut[better]
            at = 2 * at + 1 + (bins[np.arange(len(y)), feature[at]] > above[at])
        gs, hs = (np.bincount(at - inner, w, inner + 1) for w in (g, h))
        leaves = -rate * gs / (hs + leaf)
        score += leaves[at - inner]
        made.append((feature, above, leaves))
    model.features, model.above, model.leaves = (np.array(part) for part in zip(*made))
    return model

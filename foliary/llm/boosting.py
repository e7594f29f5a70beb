"""Gradient-boosted trees for two classes on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    """edges: bin borders of each feature; each tree: feature, border and value by heap index."""

    edges: list[np.ndarray]
    depth: int
    start: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)], 1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned, out = self.bins(x), np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, border, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (binned[rows, feature[at]] > border[at])
            out += value[at]
        return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, ridge: float = 1.0, least: float = 5.0, most_bins: int = 32) -> Trees:
    """Newton boosting of the log loss; each split is the best over all features and borders."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, most_bins + 1)[1:-1])) for k in range(x.shape[1])]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(edges, depth, float(np.log(share / (1 - share))))
    binned, width = model.bins(x), most_bins + 1
    n, m = x.shape
    score = np.full(n, model.start)
    flat = binned + np.arange(m) * width
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        size = 2 ** (depth + 1) - 1
        feature, border, value = np.zeros(size, np.int64), np.full(size, width, np.int64), np.zeros(size)
        at = np.zeros(n, np.int64)
        for level in range(depth + 1):
            first, count = 2**level - 1, 2**level
            local = at - first
            if level == depth:
                value[first : first + count] = -rate * np.bincount(local, g, count) / (np.bincount(local, h, count) + ridge)
                break
            cell = (local[:, None] * (m * width) + flat).ravel()
            sums = [np.bincount(cell, np.repeat(w, m), count * m * width).reshape(count, m, width).cumsum(2) for w in (g, h)]
            whole_g, whole_h = sums[0][:, :, -1:], sums[1][:, :, -1:]
            gain = sums[0] ** 2 / (sums[1] + ridge) + (whole_g - sums[0]) ** 2 / (whole_h - sums[1] + ridge) - whole_g**2 / (whole_h + ridge)
            gain = np.where((sums[1] >= least * 0.05) & (whole_h - sums[1] >= least * 0.05), gain, 0).reshape(count, -1)
            best = gain.argmax(1)
            splits = gain[np.arange(count), best] > 1e-9
            feature[first : first + count] = best // width
            border[first : first + count] = np.where(splits, best % width, width)
            at = 2 * at + 1 + (binned[np.arange(n), feature[at]] > border[at])
        score += value[at]
        model.trees.append((feature, border, value))
    return model

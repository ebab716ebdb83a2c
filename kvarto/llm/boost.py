"""Gradient-boosted trees for several classes, on NumPy, with calibrated probabilities.

Meant for a model fitted on a bounded sample on the driver and applied in Arrow batches: trees are plain arrays.
"""

from __future__ import annotations

import numpy as np


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


class BoostedTrees:
    """Multi-class boosting with histogram splits; a tree is (feature, threshold, left, right, value) arrays."""

    def __init__(self, rounds: int = 30, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0, least: int = 3):
        self.rounds, self.depth, self.rate, self.bins, self.ridge, self.least = rounds, depth, rate, bins, ridge, least
        self.trees: list[list[tuple]] = []
        self.scale, self.shift = 1.0, np.zeros(0)

    def fit(self, x: np.ndarray, y: np.ndarray, classes: int) -> BoostedTrees:
        self.trees, self.shift = [], np.zeros(classes)
        if not len(y):
            return self
        weight = len(y) / (classes * np.maximum(1, np.bincount(y, minlength=classes)))[y]
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
        score = np.zeros((len(y), classes))
        onehot = np.eye(classes)[y]
        for _ in range(self.rounds):
            p = _softmax(score)
            trees = []
            for k in range(classes):
                gradient = (onehot[:, k] - p[:, k]) * weight
                curvature = p[:, k] * (1 - p[:, k]) * weight + 1e-6
                tree, out = self._grow(binned, edges, gradient, curvature)
                score[:, k] += out
                trees.append(tree)
            self.trees.append(trees)
        return self

    def _grow(self, binned, edges, gradient, curvature):
        nodes: list[list] = []
        out = np.zeros(len(gradient))

        def grow(rows: np.ndarray, depth: int) -> int:
            at = len(nodes)
            g, h = gradient[rows].sum(), curvature[rows].sum()
            nodes.append([-1, 0.0, 0, 0, self.rate * g / (h + self.ridge)])
            best = (1e-6, -1, 0)
            if depth and len(rows) >= 2 * self.least:
                for f, cuts in enumerate(edges):
                    if not len(cuts):
                        continue
                    b = binned[rows, f]
                    gs = np.bincount(b, gradient[rows], len(cuts) + 1).cumsum()[:-1]
                    hs = np.bincount(b, curvature[rows], len(cuts) + 1).cumsum()[:-1]
                    ns = np.bincount(b, minlength=len(cuts) + 1).cumsum()[:-1]
                    gain = gs**2 / (hs + self.ridge) + (g - gs) ** 2 / (h - hs + self.ridge) - g**2 / (h + self.ridge)
                    gain[(ns < self.least) | (len(rows) - ns < self.least)] = 0
                    i = int(gain.argmax())
                    if gain[i] > best[0]:
                        best = (gain[i], f, i)
            if best[1] < 0:
                out[rows] = nodes[at][4]
                return at
            _, f, i = best
            low = binned[rows, f] <= i
            nodes[at][:2] = [f, edges[f][i]]
            nodes[at][2] = grow(rows[low], depth - 1)
            nodes[at][3] = grow(rows[~low], depth - 1)
            return at

        grow(np.arange(len(gradient)), self.depth)
        return tuple(np.array(c) for c in zip(*nodes)), out

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros((len(x), len(self.shift)))
        for trees in self.trees:
            for k, (feature, threshold, left, right, value) in enumerate(trees):
                at = np.zeros(len(x), int)
                for _ in range(self.depth):
                    f = feature[at]
                    inner = f >= 0
                    go_left = x[np.arange(len(x)), np.maximum(f, 0)] <= threshold[at]
                    at = np.where(inner, np.where(go_left, left[at], right[at]), at)
                total[:, k] += value[at]
        return total

    def calibrate(self, x: np.ndarray, y: np.ndarray, steps: int = 300, step: float = 0.1) -> BoostedTrees:
        """Fits one scale and a shift for each class to the log loss on held-out rows."""
        z, classes = self.scores(x), len(self.shift)
        onehot, scale, shift = np.eye(classes)[y], 1.0, np.zeros(classes)
        for _ in range(steps):
            wrong = _softmax(scale * z + shift) - onehot
            scale = float(np.clip(scale - step * ((wrong * z).sum(1).mean() + 0.01 * (scale - 1)), 0.1, 10))
            shift -= step * (wrong.mean(0) + 0.1 * shift)
        self.scale, self.shift = scale, shift
        return self

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _softmax(self.scale * self.scores(x) + self.shift)

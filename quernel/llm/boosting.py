"""Gradient-boosted regression trees for the logistic loss, small enough to train on a driver in a second or two."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of fixed depth over float features; each split tests feature <= threshold.

    Features are few-valued (flags, counts, shares), so every distinct value is tried as a threshold, up
    to 32 of them by quantile.
    """

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.25, smallest: int = 4, ridge: float = 1.0) -> None:
        self.trees, self.depth, self.rate, self.smallest, self.ridge = trees, depth, rate, smallest, ridge
        self.bias = 0.0
        self.feature = np.zeros((0, 0), dtype=np.int64)
        self.threshold = self.value = np.zeros((0, 0))
        self.cutoff = 0.5

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        nodes, leaves = (1 << self.depth) - 1, 1 << self.depth
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.bias = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.bias)
        cuts = []
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            middle = (values[1:] + values[:-1]) / 2
            cuts.append(middle if len(middle) <= 32 else np.unique(np.quantile(x[:, j], np.linspace(0.03, 0.97, 32))))
        # bin of a row: how many cuts lie below its value, so that bins up to c are the rows with feature <= cut c
        bins = [np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]
        width = max([len(c) for c in cuts], default=0) + 1
        self.feature = np.zeros((self.trees, nodes), dtype=np.int64)
        self.threshold = np.full((self.trees, nodes), np.inf)
        self.value = np.zeros((self.trees, leaves))
        for k in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            gradient, weight = y - p, p * (1 - p)
            place = np.zeros(len(y), dtype=np.int64)
            for level in range(self.depth):
                first, here = (1 << level) - 1, 1 << level
                own = (place - first) * width
                best, choice = np.full(here, -np.inf), [(0, np.inf)] * here
                total = [np.bincount(place - first, v, here) for v in (gradient, weight)]
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    at = own + bins[j]
                    gl, hl, nl = (np.cumsum(np.bincount(at, v, here * width).reshape(here, width), axis=1) for v in (gradient, weight, None))
                    n = nl[:, -1:]
                    gl, hl, nl = gl[:, : len(c)], hl[:, : len(c)], nl[:, : len(c)]
                    gain = gl**2 / (hl + self.ridge) + (total[0][:, None] - gl) ** 2 / (np.maximum(total[1][:, None] - hl, 0) + self.ridge)
                    gain[(nl < self.smallest) | (n - nl < self.smallest)] = -np.inf
                    top = gain.argmax(axis=1)
                    for node in np.flatnonzero(gain[np.arange(here), top] > best).tolist():
                        best[node], choice[node] = gain[node, top[node]], (j, c[top[node]])
                splits = best > total[0] ** 2 / (total[1] + self.ridge) + 1e-9
                for node in range(here):
                    if splits[node]:
                        self.feature[k, first + node], self.threshold[k, first + node] = choice[node]
                place = 2 * place + 1 + (x[np.arange(len(x)), self.feature[k, place]] > self.threshold[k, place])
            place -= nodes
            self.value[k] = self.rate * np.bincount(place, gradient, leaves) / (np.bincount(place, weight, leaves) + self.ridge)
            score += self.value[k, place]
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.bias)
        every = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            place = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                place = 2 * place + 1 + (x[every, feature[place]] > threshold[place])
            score += value[place - len(feature)]
        return 1 / (1 + np.exp(-score))

    def calibrate(self, x: np.ndarray, y: np.ndarray, others: float = 1.0) -> BoostedTrees:
        """Set the cutoff to the one nearest to a half of those with almost the best F1 on rows that were held out.

        others says how many times as many rows that are not true there are in the texts to come.
        """
        p = self.probability(x)
        grid = np.linspace(0.02, 0.98, 97)
        right, wrong = (np.array([((p >= c) & (y == v)).sum() for c in grid]) for v in (1, 0))
        f1 = 2 * right / np.maximum(1, right + others * wrong + (y > 0).sum())
        best = grid[f1 >= f1.max() - 0.002]
        self.cutoff = float(best[np.abs(best - 0.5).argmin()])
        return self

"""Gradient boosted trees for a yes/no label. Logistic loss, trees of fixed depth over binned features.

Trees need sums per node and bin only, so models grow from any number of parts of the rows: each part gives its sums, and adding
them up is all that has to come together. Several models over the same rows grow in step.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class Boosted:
    """``rounds`` trees of ``depth`` levels; each node splits where the second-order gain is largest."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.cuts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # the same trees over bins
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Boosted:
        weight = np.ones(len(y)) if weight is None else weight
        edges = [np.unique(np.quantile(column, np.linspace(0, 1, self.bins + 1)[1:-1])) for column in x.T]
        part = Part(binned(x, edges), y, weight[None, :])
        grow([self.begin(edges, float(weight @ y), float(weight.sum()))], part.sums)
        return self

    def begin(self, edges: list[np.ndarray], good: float, total: float) -> Boosted:
        """Without trees yet: the score of each row is the share of the good ones."""
        mean = np.clip(good / total if total else 0.5, 1e-3, 1 - 1e-3)
        self.edges, self.start = edges, float(np.log(mean / (1 - mean)))
        return self

    def begin_tree(self) -> None:
        leaves = 1 << self.depth
        # Heap order, root at 1; where no limit is set all go left.
        self.feature, self.cut, self.limit, self.weight = np.zeros(leaves, int), np.full(leaves, self.bins), np.full(leaves, np.inf), np.zeros(leaves)

    def split(self, level: int, g: np.ndarray, h: np.ndarray) -> None:
        """Splits the nodes of a level by their sums of gradient and curvature: (node, feature, bin)."""
        width = first = 1 << level
        left_g, left_h = g.cumsum(2)[:, :, :-1], h.cumsum(2)[:, :, :-1]
        all_g, all_h = g.sum(2, keepdims=True), h.sum(2, keepdims=True)
        value = lambda a, b: a * a / (b + self.ridge)
        gain = (value(left_g, left_h) + value(all_g - left_g, all_h - left_h) - value(all_g, all_h)).reshape(width, -1)
        best = gain.argmax(1)
        for k in range(width):
            f, cut = divmod(int(best[k]), self.bins - 1)
            splits = gain[k, best[k]] > 1e-6 and cut < len(self.edges[f])
            if splits:
                self.feature[first + k], self.cut[first + k], self.limit[first + k] = f, cut, self.edges[f][cut]
            if level == self.depth - 1:
                low = (left_g[k, f, cut], left_h[k, f, cut]) if splits else (all_g[k, f, 0], all_h[k, f, 0])
                for side, a, b in ((0, *low), (1, all_g[k, f, 0] - low[0], all_h[k, f, 0] - low[1])):
                    self.weight[2 * k + side] = -self.rate * a / (b + self.ridge)
        if level == self.depth - 1:
            self.trees.append((self.feature, self.limit, self.weight))
            self.cuts.append((self.feature, self.cut, self.weight))

    def node(self, bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
        rows, node = np.arange(len(bins)), np.ones(len(bins), int)
        for _ in range(levels):
            node = 2 * node + (bins[rows, feature[node]] > cut[node])
        return node

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, limit, weight in self.trees:
            node = np.ones(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + (x[rows, feature[node]] > limit[node])
            margin += weight[node - len(weight)]
        return 1 / (1 + np.exp(-margin))


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T, strict=True)], 1).astype(np.uint8)


class Part:
    """Binned rows with their labels and, per model, their weights. Scores follow the finished trees."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, weights: np.ndarray):
        self.bins, self.y, self.weights = bins, y, weights
        self.margins, self.applied = [None] * len(weights), [0] * len(weights)

    def score(self, i: int, model: Boosted) -> np.ndarray:
        if self.margins[i] is None:
            self.margins[i] = np.full(len(self.y), model.start)
        for feature, cut, weight in model.cuts[self.applied[i]:]:
            self.margins[i] += weight[model.node(self.bins, feature, cut, model.depth) - len(weight)]
        self.applied[i] = len(model.cuts)
        return 1 / (1 + np.exp(-self.margins[i]))

    def sums(self, models: list[Boosted], level: int) -> np.ndarray:
        """(model, gradient and curvature, node of the level, feature, bin)."""
        n_features, out = self.bins.shape[1], []
        for i, model in enumerate(models):
            p, shape = self.score(i, model), (1 << level, n_features, model.bins)
            node = model.node(self.bins, model.feature, model.cut, level) - (1 << level)
            cell = ((node[:, None] * n_features + np.arange(n_features)) * model.bins + self.bins).ravel()
            for v in (self.weights[i] * (p - self.y), self.weights[i] * p * (1 - p)):
                out.append(np.bincount(cell, np.repeat(v, n_features), int(np.prod(shape))).reshape(shape))
        return np.stack(out).reshape(len(models), 2, *shape)


def grow(models: list[Boosted], sums: Callable[[list[Boosted], int], np.ndarray]) -> None:
    """Grows all models by the sums over all rows that ``sums`` gives for a level of each model's open tree."""
    for _ in range(models[0].rounds):
        for model in models:
            model.begin_tree()
        for level in range(models[0].depth):
            for model, (g, h) in zip(models, sums(models, level), strict=True):
                model.split(level, g, h)

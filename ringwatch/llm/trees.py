"""Gradient-boosted regression trees for two classes, in numpy."""

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays; a leaf has feature -1 and its value."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            feature = self.feature[at]
            inner = np.flatnonzero(feature >= 0)
            if not len(inner):
                return self.value[at]
            node = at[inner]
            low = x[inner, feature[inner]] <= self.cut[node]
            at[inner] = np.where(low, self.left[node], self.right[node])


@dataclass(frozen=True)
class Boosted:
    start: float
    trees: tuple[Tree, ...]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((t.predict(x) for t in self.trees), np.zeros(len(x)))


def _grow(binned, bins, edges, gradient, hessian, depth, penalty, rate, least) -> Tree:
    width = binned.shape[1]
    feature, cut, left, right, value = [], [], [], [], []

    def split(rows: np.ndarray, level: int) -> int:
        node = len(feature)
        g, h = gradient[rows].sum(), hessian[rows].sum()
        for array, first in ((feature, -1), (cut, 0.0), (left, -1), (right, -1), (value, -rate * g / (h + penalty))):
            array.append(first)
        if level == depth or len(rows) < 2 * least:
            return node
        codes = binned[rows].ravel()

        def below(values) -> np.ndarray:
            """Sums of the rows up to each bin, per feature."""
            spread = None if values is None else np.repeat(values[rows], width)
            return np.bincount(codes, spread, width * bins).reshape(width, bins).cumsum(axis=1)[:, :-1]

        gl, hl, nl = below(gradient), below(hessian), below(None)
        gain = gl**2 / (hl + penalty) + (g - gl) ** 2 / (h - hl + penalty) - g**2 / (h + penalty)
        gain[(nl < least) | (len(rows) - nl < least)] = -1
        f, i = divmod(int(gain.argmax()), bins - 1)
        chosen = (f, i) if gain[f, i] > 1e-6 else None
        if chosen:
            f, i = chosen
            low = binned[rows, f] - f * bins <= i
            feature[node], cut[node] = f, edges[f][i]
            left[node] = split(rows[low], level + 1)
            right[node] = split(rows[~low], level + 1)
        return node

    split(np.arange(len(binned)), 0)
    return Tree(*map(np.array, (feature, cut, left, right, value)))


def fit(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 40, depth: int = 4,
    rate: float = 0.3, bins: int = 32, penalty: float = 1.0, least: int = 8,
) -> Boosted:
    """Logistic loss, second-order steps, splits at quantiles of each feature."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    edges = [e[e < x[:, f].max()] for f, e in enumerate(edges)]
    # The bin of a feature, counted on from the bins of the features before it.
    binned = np.column_stack([
        np.searchsorted(e, x[:, f], side="left") + f * bins for f, e in enumerate(edges)
    ])
    mean = np.average(y, weights=weight).clip(1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    score, grown = np.full(len(y), start), []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-score))
        tree = _grow(binned, bins, edges, weight * (chance - y), weight * chance * (1 - chance), depth, penalty, rate, least)
        grown.append(tree)
        score = score + tree.predict(x)
    return Boosted(start, tuple(grown))

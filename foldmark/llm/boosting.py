"""Gradient-boosted trees for the logistic loss, in numpy: quantile bins, depth-wise growth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    bias: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # split feature (-1: none), threshold, leaf value
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for feature, threshold, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                right = (f >= 0) & (x[rows, np.maximum(f, 0)] > threshold[node])
                node = 2 * node + 1 + right
            out += leaf[node - (2**self.depth - 1)]
        return out

    def proba(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, l2: float = 1.0, bins: int = 32) -> Boosted:
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    wide = max(2, max(len(c) for c in cuts) + 1)  # bins of a feature, with unused ones
    offset = np.arange(len(cuts)) * wide
    inside = np.arange(wide - 1)[None, :] < np.array([len(c) for c in cuts])[:, None]
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model = Boosted(float(np.log(mean / (1 - mean))), [], depth)
    score = np.full(len(y), model.bias)
    inner = 2**depth - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        grad, hess = y - p, p * (1 - p)
        feature, threshold = np.full(inner, -1), np.zeros(inner)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            for n in range(2**level - 1, 2 ** (level + 1) - 1):
                own = np.flatnonzero(node == n)
                if len(own) >= 8:
                    g, h = grad[own].sum(), hess[own].sum()
                    place = (binned[own] + offset).ravel()
                    gl = np.bincount(place, np.repeat(grad[own], len(cuts)), len(cuts) * wide).reshape(-1, wide).cumsum(1)[:, :-1]
                    hl = np.bincount(place, np.repeat(hess[own], len(cuts)), len(cuts) * wide).reshape(-1, wide).cumsum(1)[:, :-1]
                    gain = np.where(inside, gl**2 / (hl + l2) + (g - gl) ** 2 / (h - hl + l2) - g**2 / (h + l2), 0.0)
                    f, k = np.unravel_index(int(gain.argmax()), gain.shape)
                    if gain[f, k] > 1e-9:
                        feature[n], threshold[n] = f, cuts[f][k]
            right = (feature[node] >= 0) & (x[np.arange(len(y)), np.maximum(feature[node], 0)] > threshold[node])
            node = 2 * node + 1 + right
        node -= inner
        leaf = rate * np.bincount(node, grad, 2**depth) / (np.bincount(node, hess, 2**depth) + l2)
        model.trees.append((feature, threshold, leaf))
        score += leaf[node]
    return model

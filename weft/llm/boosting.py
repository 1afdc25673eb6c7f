"""Histogram gradient-boosted trees and isotonic calibration in numpy, for small dense training samples."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Logistic gradient boosting of complete binary trees over quantile bins (Friedman 2001)."""

    rounds: int = 80
    depth: int = 3
    rate: float = 0.15
    bins: int = 64
    l2: float = 1.0
    least: int = 10
    cuts: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    base: float = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, k], "right") for k, c in enumerate(self.cuts)]).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        self.cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins + 1)[1:-1], method="nearest")) for k in range(x.shape[1])]
        b, raw = self._binned(x), np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-raw))
            g, h = p - y, p * (1 - p)
            feature, cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, self.bins + 1)
            node = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                self._split(b, g, h, node, 2**level - 1, 2**level, feature, cut)
                node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] >= cut[node])
            leaf = node - (2**self.depth - 1)
            value = -self.rate * np.bincount(leaf, g, 2**self.depth) / (np.bincount(leaf, h, 2**self.depth) + self.l2)
            raw += value[leaf]
            self.trees.append((feature, cut, value))
        return self

    def _split(self, b, g, h, node, first, n, feature, cut) -> None:
        """Best split of each node of a level, by gain over histograms."""
        best = np.full(n, 1e-6)
        at, width = node - first, self.bins + 1
        for k in range(b.shape[1]):
            cell = at * width + b[:, k]
            gs, hs, cs = (np.cumsum(np.bincount(cell, w, n * width).reshape(n, width), 1) for w in (g, h, None))
            gl, hl, cl = gs[:, :-1], hs[:, :-1], cs[:, :-1]
            gt, ht, ct = gs[:, -1:], hs[:, -1:], cs[:, -1:]
            gain = gl**2 / (hl + self.l2) + (gt - gl) ** 2 / (ht - hl + self.l2) - gt**2 / (ht + self.l2)
            gain[(cl < self.least) | (ct - cl < self.least)] = -1
            top = gain.argmax(1)
            better = gain[np.arange(n), top] > best
            best[better] = gain[np.arange(n), top][better]
            feature[first : first + n][better] = k
            cut[first : first + n][better] = top[better] + 1

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, total, rows = self._binned(x), np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[rows, feature[node]] >= cut[node])
            total += value[node - (2**self.depth - 1)]
        return total


@dataclass
class Isotonic:
    """Monotone calibration by pooling adjacent violators; between the pooled blocks it is linear."""

    at: np.ndarray = field(default_factory=lambda: np.array([0.0]))
    value: np.ndarray = field(default_factory=lambda: np.array([0.5]))

    def fit(self, score: np.ndarray, y: np.ndarray) -> Isotonic:
        blocks: list[list[float]] = []
        for s, t in sorted(zip(score.tolist(), y.tolist(), strict=True)):
            blocks.append([s, t, 1.0])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
                s2, t2, n2 = blocks.pop()
                s1, t1, n1 = blocks[-1]
                blocks[-1] = [(s1 * n1 + s2 * n2) / (n1 + n2), t1 + t2, n1 + n2]
        self.at = np.array([b[0] for b in blocks])
        self.value = np.array([(b[1] + 0.5) / (b[2] + 1) if len(blocks) == 1 else b[1] / b[2] for b in blocks])
        return self

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.at, self.value)

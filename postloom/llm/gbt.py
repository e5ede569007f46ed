"""Histogram gradient-boosted trees, flattened into arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """All trees' nodes side by side; a leaf points to itself. Feature values at most ``threshold`` go left."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        out = np.empty(len(x))
        for at in range(0, len(x), 4096):
            part = x[at : at + 4096]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                node = np.where(part[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out[at : at + 4096] = self.value[node].sum(1) + self.base
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, least: int = 8, l2: float = 2.0) -> Trees:
    """Boosted trees for the log loss; splits are searched in histograms of at most ``bins`` quantile bins.

    Without rows of both labels every score is the smoothed share of label 1.
    """
    n, width = x.shape
    positive = (y.sum() + 1) / (n + 2)
    base = float(np.log(positive / (1 - positive)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(v: float) -> int:
        k = len(value)
        feature.append(0)
        threshold.append(0.0)
        left.append(k)
        right.append(k)
        value.append(v)
        return k

    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
        cells = binned + np.arange(width) * bins
        f = np.full(n, base)

        def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int) -> int:
            total_g, total_h = g[rows].sum(), h[rows].sum()
            best = (1e-6, -1, 0)
            if level and len(rows) >= 2 * least:
                at = cells[rows].ravel()
                shape = (width, bins)
                sums = [np.bincount(at, np.repeat(w[rows], width), width * bins).reshape(shape).cumsum(1) for w in (g, h)]
                counts = np.bincount(at, minlength=width * bins).reshape(shape).cumsum(1)
                gl, hl = sums
                gain = gl**2 / (hl + l2) + (total_g - gl) ** 2 / (total_h - hl + l2) - total_g**2 / (total_h + l2)
                gain[(counts < least) | (len(rows) - counts < least)] = 0
                j, b = divmod(int(gain.argmax()), bins)
                best = max(best, (float(gain[j, b]), j, b))
            k = leaf(float(-rate * total_g / (total_h + l2)))
            if best[1] >= 0:
                _, j, b = best
                feature[k], threshold[k] = j, float(edges[j][b])
                goes = binned[rows, j] <= b
                left[k] = grow(rows[goes], g, h, level - 1)
                right[k] = grow(rows[~goes], g, h, level - 1)
                value[k] = 0.0
            else:
                f[rows] += value[k]
            return k

        for _ in range(trees):
            p = 1 / (1 + np.exp(-f))
            roots.append(grow(np.arange(n), p - y, p * (1 - p), depth))
    else:
        roots.append(leaf(0.0))
    ints = [np.array(a, "i4") for a in (roots, feature, left, right)]
    return Trees(base, ints[0], ints[1], np.array(threshold), ints[2], ints[3], np.array(value), depth)

"""Gradient-boosted trees for a yes-or-no question in numpy: logistic loss, small trees grown level by level on quantile
bins, and a calibration of the scores by pooling adjacent violators on rows kept apart."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees as arrays: feature and threshold of each inner node, value of each leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float
    levels: np.ndarray
    calibrated: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = (self.feature.shape[1] + 1).bit_length() - 1
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += leaf[at - len(f)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        """The calibrated probability of yes."""
        return np.interp(self.raw(x), self.levels, self.calibrated)


def pooled(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of y on score: the mean score and value of each pool, shrunk a little from 0 and 1."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []
    for s, v in zip(score[order], y[order]):
        pools.append([float(s), float(v), 1.0])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            s2, v2, n2 = pools.pop()
            s1, v1, n1 = pools[-1]
            pools[-1] = [(s1 * n1 + s2 * n2) / (n1 + n2), v1 + v2, n1 + n2]
    return np.array([p[0] for p in pools]), np.array([(p[1] + 0.5) / (p[2] + 1.0) for p in pools])


def fit(x: np.ndarray, y: np.ndarray, held_x: np.ndarray, held_y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Trees for rows `x` and answers `y` (0 or 1), their scores calibrated on other rows, `held_x` and `held_y`."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    total, inner = np.full(len(x), base), 2**depth - 1
    features, thresholds, leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        f, t = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(len(x), np.int64)
        for node in range(inner):
            here = np.flatnonzero(at == node)
            best = 1e-6
            if len(here) >= 8:
                whole_g, whole_h = g[here].sum(), h[here].sum()
                for j in range(x.shape[1]):
                    sg = np.cumsum(np.bincount(binned[here, j], g[here], len(cuts[j]) + 1))[:-1]
                    sh = np.cumsum(np.bincount(binned[here, j], h[here], len(cuts[j]) + 1))[:-1]
                    gain = sg**2 / (sh + ridge) + (whole_g - sg) ** 2 / (whole_h - sh + ridge) - whole_g**2 / (whole_h + ridge)
                    if len(gain) and gain.max() > best:
                        best, f[node], t[node] = gain.max(), j, cuts[j][int(gain.argmax())]
            at[here] = 2 * node + 1 + (x[here, f[node]] > t[node])
        at -= inner
        leaf = rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + ridge)
        total += leaf[at]
        features.append(f), thresholds.append(t), leaves.append(leaf)
    made = Trees(np.array(features), np.array(thresholds), np.array(leaves), base, np.zeros(1), np.zeros(1))
    made.levels, made.calibrated = pooled(made.raw(held_x), held_y)
    return made

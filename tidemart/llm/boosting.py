"""Gradient-boosted trees on binned features with logistic loss, and isotonic calibration, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Trees:
    """Complete trees of one depth; node k has children 2k + 1 and 2k + 2."""

    start: float
    features: np.ndarray  # trees x inner nodes
    cuts: np.ndarray      # go right where the value is above the cut
    leaves: np.ndarray    # trees x leaves

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.features.shape[1]
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.intp)
            while len(x) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - inner]
        return total


def _best_split(codes: np.ndarray, grad: np.ndarray, hess: np.ndarray, penalty: float) -> tuple[int, int]:
    """(feature, bin) of the largest gain; the last bin, which sends every row left, without one."""
    g, h = grad.sum(), hess.sum()
    best = (1e-9, 0, BINS)
    for f in range(codes.shape[1]):
        left_g = np.cumsum(np.bincount(codes[:, f], grad, BINS + 1))
        left_h = np.cumsum(np.bincount(codes[:, f], hess, BINS + 1))
        gain = (left_g ** 2 / (left_h + penalty) + (g - left_g) ** 2 / (h - left_h + penalty)
                - g ** 2 / (h + penalty))
        gain[(left_h < 1e-3) | (h - left_h < 1e-3)] = 0
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], f, k)
    return best[1], best[2]


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2,
        penalty: float = 1.0) -> Trees:
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    score, inner = np.full(len(y), start), (1 << depth) - 1
    features, cuts = np.zeros((trees, inner), np.intp), np.full((trees, inner), np.inf)
    leaves = np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess, node = p - y, p * (1 - p), np.zeros(len(y), np.intp)
        for k in range(inner):
            mine = np.flatnonzero(node == k)
            right = np.zeros(len(mine), np.intp)
            if len(mine):
                f, b = _best_split(codes[mine], grad[mine], hess[mine], penalty)
                if b < len(edges[f]):
                    features[t, k], cuts[t, k] = f, edges[f][b]
                    right = (codes[mine, f] > b).astype(np.intp)
            node[mine] = 2 * k + 1 + right
        for leaf in range(inner + 1):
            mine = node == leaf + inner
            leaves[t, leaf] = -rate * grad[mine].sum() / (hess[mine].sum() + penalty)
        score += leaves[t, node - inner]
    return Trees(start, features, cuts, leaves)


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit of y on score: pools of adjacent violators, at their mean scores.

    Each pool's rate is drawn towards the overall rate by one pseudo-row, so that no pool is certain.
    """
    pools: list[list[float]] = []
    for s, label in sorted(zip(score.tolist(), y.tolist(), strict=True)):
        pools.append([label, 1.0, s])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            total, n, at = pools.pop()
            pools[-1] = [pools[-1][0] + total, pools[-1][1] + n, pools[-1][2] + at]
    base = float(y.mean())
    rates = np.maximum.accumulate([(p[0] + base) / (p[1] + 1) for p in pools])
    return np.array([p[2] / p[1] for p in pools]), rates

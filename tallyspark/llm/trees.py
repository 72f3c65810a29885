"""Gradient-boosted trees for two classes, with monotonic constraints, as flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Trees as arrays over nodes.  A leaf points to itself, so every row may take ``depth`` steps."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of class 1; a missing value counts as 0."""
        x = np.nan_to_num(np.asarray(x, float))
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                go_low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(go_low, self.low[node], self.high[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.raw(x)))


def _best_split(grad, hess, codes, rows, bins, monotone, bounds, ridge, least):
    """(gain, feature, bin, low weight, high weight) of the best allowed split of ``rows``, or None."""
    low_bound, high_bound = bounds
    weight = lambda g, h: np.clip(-g / (h + ridge), low_bound, high_bound)
    value = lambda g, h, w: -(g * w + 0.5 * (h + ridge) * w * w)
    g_all, h_all = grad[rows].sum(), hess[rows].sum()
    here = value(g_all, h_all, weight(g_all, h_all))
    best = None
    for f in range(codes.shape[1]):
        c = codes[rows, f]
        g = np.cumsum(np.bincount(c, grad[rows], bins))[:-1]
        h = np.cumsum(np.bincount(c, hess[rows], bins))[:-1]
        wl, wh = weight(g, h), weight(g_all - g, h_all - h)
        gain = value(g, h, wl) + value(g_all - g, h_all - h, wh) - here
        allowed = (h >= least) & (h_all - h >= least) & (monotone[f] * (wh - wl) >= 0)
        gain = np.where(allowed, gain, -np.inf)
        at = int(np.argmax(gain))
        if gain[at] > 1e-6 and (best is None or gain[at] > best[0]):
            best = (gain[at], f, at, wl[at], wh[at])
    return best


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: list[int] | None = None,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    ridge: float = 1.0,
    least: float = 2.0,
) -> Forest:
    """Boost ``trees`` trees on the log loss of labels 0 and 1.

    ``monotone[f]`` is 1 where the probability must not fall as feature ``f`` rises, -1 where
    it must not rise, else 0.  A split that would break the order is refused, and the mean of
    its two weights bounds all that grows below on either side.
    """
    x = np.nan_to_num(np.asarray(x, float))
    y = np.asarray(y, float)
    monotone = np.asarray(monotone if monotone is not None else [0] * x.shape[1])
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score = np.full(len(y), base)
    feature, threshold, low, high, value, roots = [], [], [], [], [], []

    def node(w: float) -> int:
        k = len(value)
        feature.append(0)
        threshold.append(0.0)
        low.append(k)
        high.append(k)
        value.append(w)
        return k

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, p * (1 - p)
        start = node(rate * float(-grad.sum() / (hess.sum() + ridge)))
        roots.append(start)
        open_nodes = [(start, np.arange(len(y)), (-np.inf, np.inf))]
        for _ in range(depth):
            below = []
            for k, rows, bounds in open_nodes:
                found = _best_split(grad, hess, codes, rows, bins, monotone, bounds, ridge, least)
                if found is None:
                    continue
                _, f, at, wl, wh = found
                if at >= len(cuts[f]):
                    continue
                feature[k], threshold[k] = f, float(cuts[f][at])
                low[k], high[k] = node(rate * float(wl)), node(rate * float(wh))
                middle = (wl + wh) / 2
                sides = [bounds, bounds]
                if monotone[f] > 0:
                    sides = [(bounds[0], middle), (middle, bounds[1])]
                elif monotone[f] < 0:
                    sides = [(middle, bounds[1]), (bounds[0], middle)]
                goes_low = codes[rows, f] <= at
                below += [(low[k], rows[goes_low], sides[0]), (high[k], rows[~goes_low], sides[1])]
            open_nodes = below
        arrays = Forest(np.array([start]), *map(np.array, (feature, threshold, low, high, value)), depth, 0.0)
        score = score + arrays.raw(x)
    return Forest(np.array(roots, int), *map(np.array, (feature, threshold, low, high, value)), depth, base)

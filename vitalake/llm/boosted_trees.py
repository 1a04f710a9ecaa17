"""Gradient-boosted regression trees for a binary label, in numpy: histogram
splits with monotonic constraints, stored as flat node arrays."""

from __future__ import annotations

import numpy as np


class Trees:
    """Flat node arrays of all trees: feature (-1: leaf), threshold, left child,
    value; the right child follows the left.  ``roots`` are the trees' first nodes."""

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, value: np.ndarray, roots: np.ndarray,
                 shift: float, depth: int):
        self.feature, self.threshold, self.left, self.value = feature, threshold, left, value
        self.roots, self.shift, self.depth = roots, shift, depth

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row: all rows walk down each tree together."""
        out = np.full(len(x), self.shift)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > self.threshold[node]
                node = np.where(inner, self.left[node] + right, node)
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64,
        ridge: float = 1.0, least: int = 20) -> Trees:
    """``monotone``: for each feature 1 (the probability never falls as it grows),
    -1 (never rises) or 0.  A constrained split must order its sides, and the
    mid value bounds everything below it on either side."""
    n, m = x.shape
    share = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    shift = float(np.log(share / (1 - share)))
    feature, threshold, left, value, roots = [], [], [], [], []
    if n == 0 or m == 0 or y.min() == y.max():
        return Trees(np.array([-1]), np.zeros(1), np.zeros(1, int), np.zeros(1), np.zeros(0, int), shift, depth)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(m)]
    code = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(m)], axis=1)
    raw = np.full(n, shift)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        roots.append(len(feature))
        feature.append(-1)
        threshold.append(0.0)
        left.append(0)
        value.append(0.0)
        open_ = [(roots[-1], np.arange(n), -np.inf, np.inf, 0)]
        step = np.zeros(n)
        while open_:
            node, rows, low, high, level = open_.pop()
            sg, sh = g[rows].sum(), h[rows].sum()
            best = np.clip(-sg / (sh + ridge), low, high)
            value[node] = rate * best
            step[rows] = value[node]
            if level == depth or len(rows) < 2 * least:
                continue
            gain_of = lambda a, b, w: -(a * w + 0.5 * (b + ridge) * w * w)
            top = (1e-6, -1, 0, 0.0)
            for f in range(m):
                if not len(edges[f]):
                    continue
                c = code[rows, f]
                size = len(edges[f]) + 1
                cg, ch, cn = (np.cumsum(np.bincount(c, w, size))[:-1] for w in (g[rows], h[rows], None))
                wl = np.clip(-cg / (ch + ridge), low, high)
                wr = np.clip(-(sg - cg) / (sh - ch + ridge), low, high)
                gain = gain_of(cg, ch, wl) + gain_of(sg - cg, sh - ch, wr) - gain_of(sg, sh, best)
                fine = (cn >= least) & (len(rows) - cn >= least)
                if monotone[f]:
                    fine &= monotone[f] * (wr - wl) >= 0
                gain = np.where(fine, gain, -np.inf)
                k = int(gain.argmax())
                if gain[k] > top[0]:
                    top = (gain[k], f, k, (wl[k] + wr[k]) / 2)
            _, f, k, mid = top
            if f < 0:
                continue
            feature[node], threshold[node], left[node] = f, float(edges[f][k]), len(feature)
            feature += [-1, -1]
            threshold += [0.0, 0.0]
            left += [0, 0]
            value += [0.0, 0.0]
            side = code[rows, f] > k
            bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid)), 0: ((low, high), (low, high))}[int(monotone[f])]
            open_.append((left[node], rows[~side], *bounds[0], level + 1))
            open_.append((left[node] + 1, rows[side], *bounds[1], level + 1))
        raw += step
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(value), np.array(roots), shift, depth)

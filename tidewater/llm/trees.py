"""Gradient-boosted trees for a binary label, fitted with numpy on a bounded
sample and flattened into node arrays for vectorised scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of one depth: ``feature`` and ``threshold`` per
    inner node (node k has the children 2k+1 and 2k+2), ``value`` per leaf.
    An unsplit node has the threshold +inf and equal leaves below."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(x)), np.full(len(x), self.base)
        for t in range(len(self.value)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, self.feature[t, node]] > self.threshold[t, node])
            out += self.value[t, node - (2 ** self.depth - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def constant(p: float) -> Trees:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return Trees(np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)), float(np.log(p / (1 - p))), 1)


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 3,
        rate: float = 0.2, bins: int = 64, l2: float = 1.0, min_weight: float = 1.0) -> Trees:
    """Logistic boosting. ``monotone`` has +1, -1 or 0 per feature: the score
    never falls (rises) as that feature grows. With no rows the model is the
    constant 0.5; with one class, nearly that class."""
    if not len(y) or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.5)
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    inner, p = 2 ** depth - 1, y.mean()
    model = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, 2 ** depth)), float(np.log(p / (1 - p))), depth)
    score = np.full(n, model.base)
    for t in range(trees):
        prob = 1 / (1 + np.exp(-score))
        grad, hess = y - prob, np.maximum(prob * (1 - prob), 1e-6)
        node = np.zeros(n, np.int64)
        bounds = {0: (-np.inf, np.inf)}
        own = {0: float(grad.sum() / (hess.sum() + l2))}
        for k in range(inner):
            lo, hi = bounds[k]
            rows = np.flatnonzero(node == k)
            best = (1e-9, None, None, own[k], own[k])
            g, h = grad[rows], hess[rows]
            gs, hs = g.sum(), h.sum()
            for j in range(width):
                if not len(edges[j]) or len(rows) < 2:
                    continue
                size = len(edges[j]) + 1
                gl = np.cumsum(np.bincount(binned[rows, j], g, size))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, j], h, size))[:-1]
                vl = np.clip(gl / (hl + l2), lo, hi)
                vr = np.clip((gs - gl) / (hs - hl + l2), lo, hi)
                # loss reduction of the clipped leaf values against the node's own
                gain = (gl * vl - 0.5 * (hl + l2) * vl**2) + ((gs - gl) * vr - 0.5 * (hs - hl + l2) * vr**2) - (gs * own[k] - 0.5 * (hs + l2) * own[k] ** 2)
                ok = (hl >= min_weight) & (hs - hl >= min_weight)
                if monotone[j]:
                    ok &= monotone[j] * (vr - vl) >= 0
                gain = np.where(ok, gain, -1)
                b = int(np.argmax(gain))
                if gain[b] > best[0]:
                    best = (gain[b], j, b, float(vl[b]), float(vr[b]))
            _, j, b, vl, vr = best
            left, right = 2 * k + 1, 2 * k + 2
            own[left], own[right] = vl, vr
            bounds[left] = bounds[right] = (lo, hi)
            if j is None:
                node[rows] = left
                continue
            model.feature[t, k], model.threshold[t, k] = j, edges[j][b]
            node[rows] = np.where(binned[rows, j] > b, right, left)
            if monotone[j]:
                mid = (vl + vr) / 2
                bounds[left], bounds[right] = ((lo, mid), (mid, hi)) if monotone[j] > 0 else ((mid, hi), (lo, mid))
        model.value[t] = [rate * own[inner + i] for i in range(2 ** depth)]
        score += model.value[t, node - inner]
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: (knots, values) for ``np.interp``; the values
    never fall. One pseudo-row of each class per pool keeps them off 0 and 1."""
    if not len(y):
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []  # sum of y, rows, lowest score, highest score
    for s, v in zip(score[order], y[order]):
        pools.append([float(v), 1.0, float(s), float(s)])
        while len(pools) > 1 and (pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1] or pools[-2][3] == pools[-1][2]):
            a = pools.pop()
            pools[-1] = [pools[-1][0] + a[0], pools[-1][1] + a[1], pools[-1][2], a[3]]
    values = np.maximum.accumulate([(p[0] + 0.5) / (p[1] + 1) if p[1] > 1 else p[0] for p in pools])
    return np.array([k for p in pools for k in (p[2], p[3])]), np.repeat(np.clip(values, 0, 1), 2)

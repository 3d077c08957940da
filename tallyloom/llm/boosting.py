"""Small gradient-boosted trees for a bounded training sample: logistic loss, quantile bins, Platt calibration."""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES, DEPTH, BINS, RATE, L2 = 40, 3, 32, 0.2, 1.0


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Boosted:
    """Trees as complete binary arrays: inner nodes hold (feature, cut), leaves a value."""

    prior: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 1.1  # nothing is selected before fitting

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for features, cuts, values in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, features[node]] > cuts[node])
            out += values[node - (2**DEPTH - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margin(x) + self.shift) if len(x) else np.empty(0)


def _grow(bins: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray):
    """One tree: at each node the split with the largest gain over all features and bins."""
    inner = 2**DEPTH - 1
    features, cuts = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(bins), np.int64)
    for at in range(inner):
        mine = np.flatnonzero(node == at)
        best = (1e-6, 0, BINS)
        if len(mine):
            gs, hs = g[mine], h[mine]
            whole = gs.sum() ** 2 / (hs.sum() + L2)
            for f in range(bins.shape[1]):
                gl = np.cumsum(np.bincount(bins[mine, f], gs, BINS))[:-1]
                hl = np.cumsum(np.bincount(bins[mine, f], hs, BINS))[:-1]
                gain = gl**2 / (hl + L2) + (gs.sum() - gl) ** 2 / (hs.sum() - hl + L2) - whole
                gain[(hl < 1e-9) | (hs.sum() - hl < 1e-9)] = 0
                b = int(gain.argmax())
                if gain[b] > best[0]:
                    best = (gain[b], f, b)
            if best[2] < len(edges[best[1]]):
                features[at], cuts[at] = best[1], edges[best[1]][best[2]]
            node[mine] = 2 * at + 1 + (bins[mine, best[1]] > best[2])
    leaf = node - inner
    values = -RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + L2)
    return (features, cuts, values), leaf


def fit(x: np.ndarray, y: np.ndarray, held: np.ndarray, precision: float, judged: np.ndarray | None = None) -> Boosted:
    """Boost on the rows outside ``held``; calibrate and choose the threshold on those inside.

    Of these only the ``judged`` ones count, if given: those like the rows that the model will judge.

    The threshold is the smallest one of at least one half at which the held rows reach ``precision``.
    """
    model = Boosted()
    train = ~held
    if not train.any() or y[train].min(initial=1) == y[train].max(initial=0):
        return model
    edges = [np.unique(np.quantile(x[train, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[train, f]) for f, e in enumerate(edges)], axis=1)
    target = y[train].astype(float)
    model.prior = float(np.log((target.sum() + 1) / (len(target) - target.sum() + 1)))
    margin = np.full(len(target), model.prior)
    for _ in range(TREES):
        p = sigmoid(margin)
        tree, leaf = _grow(bins, edges, p - target, p * (1 - p))
        model.trees.append(tree)
        margin += tree[2][leaf]
    met = np.ones(len(y), bool) if judged is None else judged
    sets = [held & met, train & met, held, train]
    check = next(c for c in sets if y[c].min(initial=1) < y[c].max(initial=0))
    m, t = model.margin(x[check]), y[check].astype(float)
    for _ in range(50):  # Newton steps of Platt's two-parameter fit
        p = sigmoid(model.slope * m + model.shift)
        w = p * (1 - p) + 1e-6
        grad = np.array([((p - t) * m).sum() + 0.01 * (model.slope - 1), (p - t).sum() + 0.01 * model.shift])
        hess = np.array([[(w * m * m).sum() + 0.01, (w * m).sum()], [(w * m).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(hess, grad)
        model.slope, model.shift = model.slope - float(step[0]), model.shift - float(step[1])
        if np.abs(step).max() < 1e-6:
            break
    p = model.probability(x[check])
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(t[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero((right >= precision) & (p[order] >= 0.5))
    if len(good):
        # Halfway to the next lower probability, so that scores between the two are not left to chance.
        below = p[order][good[-1] + 1] if good[-1] + 1 < len(order) else 0.0
        model.threshold = max(0.5, float(p[order][good[-1]] + below) / 2)
    return model

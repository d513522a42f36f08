"""Gradient-boosted trees in numpy: complete trees in flat arrays, monotone where asked.

Trees have one depth, so node ``i`` has the children ``2 i + 1`` and ``2 i + 2`` and a row is
led through all trees by array indexing. A feature with constraint +1 (-1) can only
raise (lower) the score as it grows: a split against it is not taken, and both sides
keep to their side of the middle between them all the way down.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    feature: np.ndarray    # (trees, inner nodes), 0 where a node doesn't split
    threshold: np.ndarray  # the same; a row goes left if its value is at most this
    value: np.ndarray      # (trees, leaves)
    base: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """The log-odds of each row, over all trees at once."""
        count, inner = self.feature.shape
        out = np.full(len(rows), self.base)
        tree = np.arange(count)[None, :]
        for start in range(0, len(rows), 4096):
            part = rows[start:start + 4096]
            node = np.zeros((len(part), count), np.int64)
            line = np.arange(len(part))[:, None]
            for _ in range(int(np.log2(inner + 1))):
                right = part[line, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            out[start:start + 4096] += self.value[tree, node - inner].sum(axis=1)
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: np.ndarray, labels: np.ndarray, *, monotone: np.ndarray, trees: int = 60, depth: int = 3,
        rate: float = 0.2, bins: int = 32, ridge: float = 1.0, least: float = 5.0) -> Trees:
    """Boost on the logistic loss. Deterministic: equal gains go to the first feature and bin."""
    count, features = rows.shape
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(features)]
    codes = np.stack([np.searchsorted(cuts[f], rows[:, f], "left") for f in range(features)], axis=1)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf),
                np.zeros((trees, leaves)), base)
    margin = np.full(count, base)
    flat = codes + np.arange(features)[None, :] * bins
    for t in range(trees):
        p = sigmoid(margin)
        grad, hess = labels - p, p * (1 - p)
        node = np.zeros(count, np.int64)
        bounds = {0: (-np.inf, np.inf)}
        for i in range(inner):
            low, high = bounds[i]
            bounds[2 * i + 1] = bounds[2 * i + 2] = (low, high)
            mine = np.flatnonzero(node == i)
            best = None
            if len(mine) >= 2 * least:
                size = features * bins
                where = flat[mine].ravel()
                g = np.bincount(where, np.repeat(grad[mine], features), size).reshape(features, bins)
                h = np.bincount(where, np.repeat(hess[mine], features), size).reshape(features, bins)
                n = np.bincount(where, minlength=size).reshape(features, bins)
                gl, hl, nl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1], n.cumsum(1)[:, :-1]
                gt, ht = g.sum(1)[:, None], h.sum(1)[:, None]
                left = np.clip(gl / (hl + ridge), low, high)
                right = np.clip((gt - gl) / (ht - hl + ridge), low, high)

                def worth(v, a, b):
                    return v * a - 0.5 * v * v * (b + ridge)

                whole = np.clip(gt / (ht + ridge), low, high)
                gain = worth(left, gl, hl) + worth(right, gt - gl, ht - hl) - worth(whole, gt, ht)
                bad = (nl < least) | (len(mine) - nl < least)
                bad |= (monotone[:, None] * (right - left)) < 0
                bad |= np.arange(bins - 1)[None, :] >= np.array([len(c) for c in cuts])[:, None]
                gain[bad] = -np.inf
                f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
                if gain[f, b] > 1e-6:
                    best = (f, b, left[f, b], right[f, b])
            if best is None:
                node[mine] = 2 * i + 1
                continue
            f, b, lv, rv = best
            out.feature[t, i], out.threshold[t, i] = f, cuts[f][b]
            node[mine] = 2 * i + 1 + (codes[mine, f] > b)
            if monotone[f]:
                middle = (lv + rv) / 2
                below, above = (low, middle), (middle, high)
                bounds[2 * i + 1], bounds[2 * i + 2] = (below, above) if monotone[f] > 0 else (above, below)
        leaf = node - inner
        g, h = np.bincount(leaf, grad, leaves), np.bincount(leaf, hess, leaves)
        value = g / (h + ridge)
        for k in range(leaves):
            value[k] = np.clip(value[k], *bounds[inner + k])
        out.value[t] = rate * value
        margin += out.value[t][leaf]
    return out

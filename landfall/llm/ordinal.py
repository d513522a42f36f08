"""Cumulative-link regression in numpy: shared sparse weights, ordered thresholds.

The chance that a text's grade is above the k-th is ``sigmoid(w x - t_k)`` with one weight
vector for all k and thresholds ``t_1 <= t_2 <= ...``. Weights are learned by follow-the-
regularised-leader steps, whose lasso part keeps most weights at nought; thresholds by
plain gradient steps, sorted after each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Ordinal:
    grades: np.ndarray       # ascending grade values
    weights: np.ndarray
    thresholds: np.ndarray   # one fewer than grades

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score ``w x`` and each threshold."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])

    def expected(self, scores: np.ndarray) -> np.ndarray:
        return self.grades[0] + self.tails(scores) @ np.diff(self.grades)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train(texts: list[tuple[np.ndarray, np.ndarray]], grades: list[float], size: int, *,
          epochs: int = 5, rate: float = 0.3, lasso: float = 1.0, ridge: float = 0.1,
          seed: int = 3) -> Ordinal | None:
    """Fit to texts given as (feature ids, values); None if there are no two grades."""
    values = np.array(sorted(set(grades)), float)
    if len(values) < 2:
        return None
    rank = np.searchsorted(values, np.array(grades, float))
    levels = np.arange(len(values) - 1)
    above = np.array([(rank > k).mean() for k in levels])
    thresholds = -np.log(above / (1 - above))
    z, n, weights = (np.zeros(size) for _ in range(3))
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        for i in rng.permutation(len(texts)):
            ids, x = texts[i]
            if not len(ids):
                continue
            p = _sigmoid(weights[ids] @ x - thresholds)
            # The grade's chance is p[k-1] - p[k]; its log's slope in w x:
            k = rank[i]
            high = p[k - 1] if k else 1.0
            low = p[k] if k < len(levels) else 0.0
            chance = max(high - low, 1e-9)
            slope = (high * (1 - high) - low * (1 - low)) / chance
            g = -slope * x
            grown = n[ids] + g * g
            z[ids] += g - (np.sqrt(grown) - np.sqrt(n[ids])) / rate * weights[ids]
            n[ids] = grown
            kept = np.abs(z[ids]) > lasso
            weights[ids] = np.where(
                kept, -(z[ids] - np.sign(z[ids]) * lasso) / ((1 + np.sqrt(grown)) / rate + ridge), 0)
            step = 0.02 / (1 + epoch)
            if k:
                thresholds[k - 1] -= step * high * (1 - high) / chance
            if k < len(levels):
                thresholds[k] += step * low * (1 - low) / chance
            thresholds.sort()
    return Ordinal(values, weights, thresholds)

"""The gradients of the two fitted classifiers against finite differences of plainly written losses."""

from __future__ import annotations

import numpy as np
import pytest

from tablelens.llm import quality, toxicity
from tablelens.llm.features import Sparse

SIZE = 7


def rows_of_features(rng, n):
    """Random rows as a Sparse and as a full matrix."""
    held = [np.sort(rng.choice(SIZE, rng.integers(0, 5), replace=False)) for _ in range(n)]
    at = np.concatenate(held).astype(np.int64)
    value = rng.normal(size=len(at))
    full = np.zeros((n, SIZE))
    full[np.repeat(np.arange(n), [len(h) for h in held]), at] = value
    return Sparse(at, value, np.r_[0, np.cumsum([len(h) for h in held])]), full


def captured(monkeypatch, module, fit):
    """The gradient that a fit hands to its optimiser, and where that starts."""
    seen = []

    def adam(gradient, start, *_):
        seen.append((gradient, start))
        return start

    monkeypatch.setattr(module, "adam", adam)
    fit()
    return seen[0]


def slopes(loss, p, step=1e-6):
    out = np.zeros(len(p))
    for i in range(len(p)):
        up, down = p.copy(), p.copy()
        up[i] += step
        down[i] -= step
        out[i] = (loss(up) - loss(down)) / (2 * step)
    return out


def logistic(f):
    return np.log(1 + np.exp(-f))


@pytest.mark.parametrize("prior, bias, possible", [(0.2, 0.0, True), (0.9, -3.0, True), (0.9, 4.0, False)])
def test_risk_of_positives_and_unlabelled(monkeypatch, prior, bias, possible):
    rng = np.random.default_rng(int(10 * prior + bias))
    positive, p_rows = rows_of_features(rng, 12)
    unlabelled, u_rows = rows_of_features(rng, 30)
    gradient, _ = captured(monkeypatch, toxicity, lambda: toxicity.fit_arrays(positive, unlabelled, prior, SIZE))
    w = np.r_[rng.normal(size=SIZE) * 0.5, bias]
    if not possible:  # positives far on the wrong side of what unlabelled rows allow
        w[:SIZE] = np.linalg.lstsq(p_rows, np.full(12, 6.0), rcond=None)[0]

    def negative(v):
        return logistic(-(u_rows @ v[:-1] + v[-1])).mean() - prior * logistic(-(p_rows @ v[:-1] + v[-1])).mean()

    def loss(v):
        decay = toxicity.DECAY / 12 * (v[:-1] ** 2).sum() / 2
        if negative(w) >= 0:
            return prior * logistic(p_rows @ v[:-1] + v[-1]).mean() + negative(v) + decay
        return -negative(v) + decay

    if not possible and negative(w) >= 0:
        w = np.r_[np.zeros(SIZE), bias]
        # equal scores for all rows: the estimate is (1 - prior) times a loss, so shift the positives up
        w[:SIZE] = 8 * (p_rows.mean(axis=0) - u_rows.mean(axis=0))
    assert (negative(w) >= 0) == possible
    assert np.allclose(gradient(w), slopes(loss, w), atol=1e-6)


@pytest.mark.parametrize("grades", [2, 3, 5])
def test_likelihood_of_ordered_grades(monkeypatch, grades):
    rng = np.random.default_rng(grades)
    x, rows = rows_of_features(rng, 40)
    grade = np.r_[np.arange(grades), rng.integers(0, grades, 40 - grades)]
    gradient, start = captured(monkeypatch, quality, lambda: quality.fit_arrays(x, grade, grades, SIZE))
    p = start + rng.normal(size=len(start)) * 0.4

    def loss(v):
        cuts = [v[SIZE]]
        for gap in v[SIZE + 1 :]:
            cuts.append(cuts[-1] + np.exp(gap))
        total = 0.0
        for row, g in zip(rows, grade, strict=True):
            at_most = [0.0, *[1 / (1 + np.exp(-(c - row @ v[:SIZE]))) for c in cuts], 1.0]
            total -= np.log(at_most[g + 1] - at_most[g])
        return total / 40 + quality.DECAY * (v[:SIZE] ** 2).sum() / 2

    assert np.allclose(gradient(p), slopes(loss, p), atol=1e-6)
    weights, thresholds = quality.fit_arrays(x, grade, grades, SIZE)
    assert len(weights) == SIZE and (np.diff(thresholds) > 0).all()

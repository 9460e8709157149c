"""The ordinal fit against the likelihood and its gradient written out row by row."""

import math
import random

import numpy as np
import pytest

from shopfloor.llm import quality


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def loss(weights, cuts, rows, grades):
    """Mean negative log-likelihood and the ridge; ``cuts``: first threshold, logs of the gaps."""
    thresholds = [cuts[0]]
    for gap in cuts[1:]:
        thresholds.append(thresholds[-1] + math.exp(gap))
    total = 0.0
    for row, grade in zip(rows, grades):
        score = sum(weights[b] for b in row if b in weights)
        upper = 1.0 if grade == len(thresholds) else sigmoid(thresholds[grade] - score)
        lower = 0.0 if grade == 0 else sigmoid(thresholds[grade - 1] - score)
        total -= math.log(max(upper - lower, 1e-12))
    return total / len(rows) + quality.RIDGE * sum(w * w for w in weights.values()) / 2


def slopes(weights, cuts, rows, grades):
    """The gradient of ``loss``, row by row: weights in order, then ``cuts``."""
    thresholds = [cuts[0]]
    for gap in cuts[1:]:
        thresholds.append(thresholds[-1] + math.exp(gap))
    by_weight, by_threshold = {b: quality.RIDGE * w for b, w in weights.items()}, [0.0] * len(thresholds)
    for row, grade in zip(rows, grades):
        score = sum(weights[b] for b in row if b in weights)
        upper = 1.0 if grade == len(thresholds) else sigmoid(thresholds[grade] - score)
        lower = 0.0 if grade == 0 else sigmoid(thresholds[grade - 1] - score)
        d_upper, d_lower = upper * (1 - upper), lower * (1 - lower)
        scale = 1 / (upper - lower) / len(rows)
        for b in row:
            if b in by_weight:
                by_weight[b] += (d_upper - d_lower) * scale
        if grade < len(thresholds):
            by_threshold[grade] -= d_upper * scale
        if grade > 0:
            by_threshold[grade - 1] += d_lower * scale
    by_cut = [sum(by_threshold)] + [sum(by_threshold[k:]) * math.exp(cuts[k]) for k in range(1, len(cuts))]
    return [*by_weight.values(), *by_cut]


def test_the_gradient_is_that_of_the_likelihood():
    dice = random.Random(9)
    grades = [dice.randrange(3) for _ in range(30)]
    rows = [dice.sample(range(4), 2) for _ in grades]
    at = [0.3, -0.8, 0.1, 0.6, -0.4, 0.2]
    for i, slope in enumerate(slopes(dict(enumerate(at[:4])), at[4:], rows, grades)):
        up, down = list(at), list(at)
        up[i], down[i] = at[i] + 1e-5, at[i] - 1e-5
        rise = loss(dict(enumerate(up[:4])), up[4:], rows, grades) - loss(dict(enumerate(down[:4])), down[4:], rows, grades)
        assert slope == pytest.approx(rise / 2e-5, abs=1e-8)


def fit_by_loops(rows, grades, n_grades):
    n, shares = len(rows), [grades.count(k) / len(grades) for k in range(n_grades)]
    seen = {}
    for row, grade in zip(rows, grades):
        for b in row:
            seen.setdefault(b, [0] * n_grades)[grade] += 1
    luck = 2 * math.log(max(len(seen), 2))
    chosen = []
    for b, counts in sorted(seen.items()):
        texts = sum(counts)
        chance = sum((c - texts * s) ** 2 / max(texts * s, 1e-9) for c, s in zip(counts, shares))
        if chance > luck and texts >= quality.MIN_TEXTS:
            chosen.append(b)
    begin = []
    for k in range(1, n_grades):
        share = sum(grades.count(j) + 0.5 for j in range(k)) / (n + 0.5 * n_grades)
        begin.append(math.log(share / (1 - share)))
    theta = [0.0] * len(chosen) + [begin[0]] + [math.log(max(b - a, 1e-3)) for a, b in zip(begin, begin[1:])]
    mean, square = [0.0] * len(theta), [0.0] * len(theta)
    for step in range(1, quality.STEPS + 1):
        gradient = slopes(dict(zip(chosen, theta)), theta[len(chosen):], rows, grades)
        rate = quality.RATE * (1 - step / (quality.STEPS + 1))
        for i, g in enumerate(gradient):
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            theta[i] -= rate * (mean[i] / (1 - 0.9**step)) / (math.sqrt(square[i] / (1 - 0.999**step)) + 1e-9)
    cuts = theta[len(chosen):]
    thresholds = [cuts[0]]
    for gap in cuts[1:]:
        thresholds.append(thresholds[-1] + math.exp(gap))
    return dict(zip(chosen, theta)), thresholds


def test_fit_equals_plain_loops(monkeypatch):
    monkeypatch.setattr(quality, "STEPS", 25)
    dice = random.Random(5)
    grades = [dice.randrange(3) for _ in range(60)]
    # Bucket 10 + grade tells the grade, mostly; 20 to 23 tell nothing; 30 is too rare.
    rows = [sorted({10 + (g if dice.random() < 0.9 else dice.randrange(3)), 20 + dice.randrange(4), *([30] if i == 0 else [])})
            for i, g in enumerate(grades)]
    offsets = np.cumsum([0] + [len(r) for r in rows])
    model = quality.fit(np.array([b for r in rows for b in r]), offsets, np.array(grades), 3)
    weights, thresholds = fit_by_loops(rows, grades, 3)
    assert set(weights) == {10, 11, 12} and set(np.flatnonzero(model.weights)) == set(weights)
    assert model.thresholds == pytest.approx(thresholds, abs=1e-4)
    assert [model.weights[b] for b in weights] == pytest.approx(list(weights.values()), abs=1e-4)


def test_tails_are_the_cumulative_link():
    model = quality.Model(np.zeros(1, np.float32), np.array([-0.5, 1.25]))
    for score in (-3.0, 0.0, 0.7, 60.0):
        got = model.tails(np.array([score]))[0]
        assert got == pytest.approx([1 - sigmoid(t - score) for t in (-0.5, 1.25)])

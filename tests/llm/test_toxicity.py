"""The toxicity model against plain Python: risk, slopes, training and scores; and its sample."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slipstream.llm import toxicity


def loss(z):
    return max(z, 0) + math.log1p(math.exp(-abs(z)))


def share(z):
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def plain_fit(positive, unlabelled, prior, least, steps, rate, decay):
    """Adam on the non-negative risk, a number at a time; words, weights and bias as dicts."""
    n, m = len(positive), len(unlabelled)
    value = {}
    for word in {w for t in positive + unlabelled for w in t}:
        inside, outside = sum(word in t for t in positive), sum(word in t for t in unlabelled)
        if inside >= least:
            value[word] = math.log((inside + 1) / (n + 2)) - math.log((outside + 1) / (m + 2))
    value = {w: v for w, v in value.items() if v}
    weight, bias = dict.fromkeys(value, 0.0), math.log(prior / (1 - prior))
    mean, square = dict.fromkeys([*value, None], 0.0), dict.fromkeys([*value, None], 0.0)
    branches = set()
    score = lambda t: bias + sum(weight[w] * value[w] for w in t if w in value)
    for step in range(1, steps + 1):
        z, y = [score(t) for t in positive], [score(t) for t in unlabelled]
        negative = sum(map(loss, y)) / m - prior * sum(map(loss, z)) / n
        branches.add(negative >= 0)
        if negative >= 0:
            slopes = [prior * (share(x) - 1) / n - prior * share(x) / n for x in z] + [share(x) / m for x in y]
        else:
            slopes = [prior * share(x) / n for x in z] + [-share(x) / m for x in y]
        grad = {w: decay * weight[w] for w in value} | {None: sum(slopes)}
        for slope, text in zip(slopes, positive + unlabelled):
            for w in text:
                if w in value:
                    grad[w] += slope * value[w]
        for w, g in grad.items():
            mean[w] += 0.1 * (g - mean[w])
            square[w] += 0.001 * (g * g - square[w])
            change = rate * (mean[w] / (1 - 0.9 ** step)) / (math.sqrt(square[w] / (1 - 0.999 ** step)) + 1e-8)
            if w is None:
                bias -= change
            else:
                weight[w] -= change
    ordered = sorted(score(t) for t in unlabelled)
    at = (1 - prior) * (m - 1)
    low = int(at)
    quantile = ordered[low] + (at - low) * (ordered[min(low + 1, m - 1)] - ordered[low])
    return {w: weight[w] * value[w] for w in value}, bias - quantile / 2, branches


def test_fit_and_scores(monkeypatch):
    monkeypatch.setattr(toxicity, "PIECE", 7)
    rng = random.Random(1)
    text = lambda telling: sorted({rng.randrange(40) for _ in range(12)} | ({50 + rng.randrange(3)} if telling else set()))
    positive, others = [text(True) for _ in range(15)], [text(k % 5 == 0) for k in range(60)] + [[]]
    arrays = lambda rows: [np.array(r, np.int32) for r in rows]
    model = toxicity.fit(toxicity.Sample.of(arrays(positive), arrays(others)), 0.2, 2, 120, 0.05, 1e-3)
    weights, bias, branches = plain_fit(positive, others, 0.2, 2, 120, 0.05, 1e-3)
    assert branches == {True, False}
    assert abs(model.bias - bias) < 1e-6
    for word in range(60):
        assert abs(model.weights[word] - weights.get(word, 0.0)) < 1e-5
    for t in positive[:3] + others[-3:]:
        assert abs(model.score(np.array(t, np.int64)) - share(bias + sum(weights.get(w, 0.0) for w in t))) < 1e-5


def test_slopes_are_those_of_the_risk():
    rng = np.random.default_rng(2)
    for shift in (-3.0, 3.0):
        z, prior, toxic = rng.normal(size=30) + np.where(np.arange(30) < 10, 4.0, shift), 0.4, 10

        def risk(x):
            negative = np.logaddexp(0, x[toxic:]).mean() - prior * np.logaddexp(0, x[:toxic]).mean()
            return prior * np.logaddexp(0, -x[:toxic]).mean() + negative if negative >= 0 else -negative

        for k in range(30):
            step = np.eye(30)[k] * 1e-6
            assert abs((risk(z + step) - risk(z - step)) / 2e-6 - toxicity.risk_slopes(z, toxic, prior)[k]) < 1e-6


@pytest.mark.parametrize("repeated", ["same text", "other texts"])
def test_sample_is_bounded(spark, monkeypatch, repeated):
    rng = random.Random(3)
    prose = lambda: " ".join(f"w{rng.randrange(99)}" for _ in range(20))
    same = prose() + " vile"
    ids = range(400)
    rows = [(i, prose() + (" vile" if i % 4 == 0 else "")) for i in ids]
    rows += [(8, same if repeated == "same text" else prose() + " vile") for _ in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in ids], "doc_id long, toxic int")
    seen = []
    real = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda sample, *a: seen.append(sample) or real(sample, *a))
    toxicity.train(frame, labels, max_positive=20, max_unlabelled=100)
    assert 1 <= seen[0].toxic <= 20 and len(seen[0].ends) <= 120


def test_score_does_not_read_labels(spark):
    frame = spark.createDataFrame([(1, "a vile text", "x", 0.5), (2, "a vile text", "y", 0.1)], "doc_id long, text string, lang string, score double")
    model = toxicity.Model(np.linspace(-1, 1, 1 << toxicity.BITS).astype(np.float32), 0.1)
    a, b = toxicity.score(frame, model).orderBy("doc_id").collect()
    assert a.score == b.score and a.lang == "x"
    assert frame.where(F.lit(False)).count() == toxicity.score(frame.where(F.lit(False)), model).count() == 0

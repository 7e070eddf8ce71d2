"""The factorization machine against plain loops over all pairs, and clashing column names."""

import math

import numpy as np
import pytest

from folioframe.llm import toxicity


def plain_margin(bias, weights, factors, features):
    total = bias + sum(weights[f] for f in features)
    for a in range(len(features)):
        for b in range(a):
            total += sum(x * y for x, y in zip(factors[features[a]], factors[features[b]]))
    return total


def test_margins_equal_a_loop_over_all_pairs():
    rng = np.random.default_rng(1)
    m = toxicity.Machine(np.arange(toxicity.PLACES), 0.3, rng.normal(size=50), rng.normal(size=(50, 8)))
    for n in (0, 1, 2, 9, 40):
        features = np.sort(rng.choice(50, n, replace=False))
        want = plain_margin(0.3, m.weights, m.factors, features.tolist())
        assert m.raw(features) == pytest.approx(want)
        assert m.score(features.tolist()) == pytest.approx(1 / (1 + math.exp(-want)))


def test_a_step_of_training_equals_plain_loops(monkeypatch):
    rng = np.random.default_rng(2)
    y = np.array([1.0] * 30 + [0.0] * 50)
    rows = [sorted({k for k in range(12) if rng.random() < (0.8 if (k < 6) == (label > 0) else 0.15)}) for label in y]
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    monkeypatch.setattr(toxicity, "BATCH", 1000)
    got = toxicity.train(rows, y, seed=5)
    kept = [k for k in range(12) if got.feature[k] >= 0]
    assert len(kept) > 8 and (got.feature[kept] == np.arange(len(kept))).all()
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias, w = math.log(share / (1 - share)), np.zeros(len(kept))
    v = np.random.default_rng(5).normal(0, 0.05, (len(kept), toxicity.FACTORS))
    features = [[kept.index(k) for k in r if k in kept] for r in rows]
    gb, gw, gv = 0.0, 1e-4 * w, 1e-4 * v
    for f, label in zip(features, y):
        error = (1 / (1 + math.exp(-plain_margin(bias, w, v, f))) - label) / len(y)
        gb += error
        for i in f:
            gw[i] += error
            for j in f:
                if j != i:
                    gv[i] += error * v[j]  # the derivative of each pair's product
    step = lambda x, g: x - 0.02 * g / (np.abs(g) + 1e-8)  # noqa: E731  (Adam's first step)
    assert got.bias == pytest.approx(step(bias, np.float64(gb)), abs=1e-6)
    assert np.allclose(got.weights, step(w, gw), atol=1e-6) and np.allclose(got.factors, step(v, gv), atol=1e-5)


def test_pairs_are_learned_that_words_alone_do_not_show(monkeypatch):
    """Two terms are toxic together, and each alone as often as not."""
    rng = np.random.default_rng(3)
    rows, y = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(sorted(([1] if a else []) + ([2] if b else []) + [10 + int(rng.integers(0, 5))]))
        y.append(float(a and b))
    monkeypatch.setattr(toxicity, "EPOCHS", 60)
    m = toxicity.train(rows, np.array(y))
    both, one = m.score([1, 2, 11]), max(m.score([1, 11]), m.score([2, 11]))
    assert both > 0.9 and one < 0.1


def test_clashing_columns_and_nulls(spark):
    docs = spark.createDataFrame([(k if k % 7 else None, "bad worse" if k % 2 else "fine day" if k % 3 else None, 1.0, "x") for k in range(60)], "doc_id bigint, text string, score double, places string")
    labels = spark.createDataFrame([(k, k % 2, "l") for k in range(60)], "doc_id bigint, toxic int, text string")
    machine = toxicity.train(*toxicity.training_rows(docs, labels))
    got = toxicity.score(spark, docs, machine).collect()
    assert len(got) == 60 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    none = docs.limit(0)
    assert toxicity.score(spark, none, toxicity.train(*toxicity.training_rows(none, labels.limit(0)))).count() == 0

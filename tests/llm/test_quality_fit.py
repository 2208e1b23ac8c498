"""The ordinal model's fit against the likelihood written out plainly."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from aurum.llm import quality


def rows(seed: int, n: int):
    """Documents as places and values, with grades that two places speak for."""
    rng = random.Random(seed)
    places, values, grades = [], [], []
    for _ in range(n):
        g = rng.randrange(3)
        own = {rng.randrange(2, 8) for _ in range(3)} | ({0} if g == 0 or rng.random() < 0.2 else set()) | ({1} if g == 2 or rng.random() < 0.2 else set())
        places.append(np.array(sorted(own), np.int32))
        values.append(np.array([1 + rng.random() for _ in own], np.float32))
        grades.append(g)
    return places, values, np.array(grades)


def likelihood(model, weights, thresholds, places, values, grades, penalty=1e-4):
    """Mean log-probability of the grades, each grade counting the same, less
    the penalty: one row at a time, with P(grade <= k) = 1 / (1 + exp(s - t_k))."""
    per = {g: 1 / (list(grades).count(g) * len(set(grades.tolist()))) for g in set(grades.tolist())}
    total = 0.0
    for p, v, g in zip(places, values, grades.tolist()):
        x = [float(a) * float(model.rarity[i]) for i, a in zip(p, v)]
        norm = math.sqrt(sum(a * a for a in x)) or 1e-12
        s = sum(weights[i] * a / norm for i, a in zip(p, x))
        tail = [1.0, *[1 / (1 + math.exp(t - s)) for t in thresholds], 0.0]  # P(grade >= k)
        total += per[g] * math.log(tail[g] - tail[g + 1])
    return total - penalty / 2 * sum(float(w) ** 2 for w in weights)


@pytest.mark.parametrize("seed", [1, 2])
def test_the_fit_is_the_plain_likelihoods_maximum(seed):
    places, values, grades = rows(seed, 90)
    model = quality.fit(places, values, grades, 3, bits=3, min_rows=1, steps=6000, rate=0.02)
    at = lambda w, t: likelihood(model, w, t, places, values, grades)
    w, t = model.weights.astype(float), np.array(model.thresholds, float)
    assert t[0] < t[1]
    best = at(w, t)
    # No step in any single weight or threshold gains, and the central difference is flat.
    for k in range(len(w) + len(t)):
        up, down = [], []
        for out, sign in ((up, 1), (down, -1)):
            w2, t2 = w.copy(), t.copy()
            (w2 if k < len(w) else t2)[k if k < len(w) else k - len(w)] += sign * 1e-3
            out.append(at(w2, t2))
        assert abs(up[0] - down[0]) / 2e-3 < 2e-3
        assert max(up[0], down[0]) <= best + 1e-5
    # Better than weights of chance, and than no weights at all.
    rng = np.random.default_rng(seed)
    assert best > at(np.zeros(len(w)), t) and all(best > at(w + rng.normal(0, 0.5, len(w)), t) for _ in range(20))


def test_tails_and_score_are_the_models(spark):
    """score() gives each text the probabilities of the formula, by hand."""
    texts = [(i, " ".join(["nasty" if i % 3 == 0 else "meh" if i % 3 == 1 else "well", f"w{i % 5}"])) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3) for i in range(60)], "doc_id long, grade int")
    model = quality.train(docs, labels, 3, bits=10, min_rows=2)
    features = quality.Features(10)
    for r in quality.score(docs, model, 3).collect():
        places, values = features(dict(texts)[r["doc_id"]])
        x = [float(v) * float(model.rarity[p]) for p, v in zip(places, values)]
        s = sum(float(model.weights[p]) * a for p, a in zip(places, x)) / math.sqrt(sum(a * a for a in x))
        want = [1 / (1 + math.exp(t - s)) for t in model.thresholds]
        assert r["p_at_least"] == pytest.approx(want, abs=1e-5) and r["expected_grade"] == pytest.approx(sum(want), abs=1e-5)
        assert r["kept"] == (want[1] >= 0.25)


def test_a_rated_id_on_many_rows_teaches_once(spark):
    docs = spark.createDataFrame([(1, "good text"), (2, "bad text")] + [(1, "good text")] * 500, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(1, 2), (2, 0)], "doc_id long, grade int")
    many = quality.train(docs, labels, 3, bits=8, min_rows=1)
    once = quality.train(docs.distinct(), labels, 3, bits=8, min_rows=1)
    assert np.array_equal(many.weights, once.weights) and np.array_equal(many.thresholds, once.thresholds)

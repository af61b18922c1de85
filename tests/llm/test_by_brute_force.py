"""Fits, sketches and window sums of the operators against plain computations."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tillcast.llm import adaptive_rules, pairwise_quality, toxic_terms


def test_sketch_quartiles_are_within_one_percent_of_exact_ones(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice("ab"), rng.lognormvariate(-3, 1.5) if rng.random() < 0.8 else 0.0) for k in range(6000)]
    df = spark.createDataFrame(rows, "k int, lang string, rate double").repartition(5)
    parts = adaptive_rules.sketched(df, ["lang"], ["rate"])
    for keys in (["lang"], []):
        got = adaptive_rules.quartiles(adaptive_rules.merged(parts, keys), keys).collect()
        assert len(got) == (2 if keys else 1)
        for r in got:
            xs = sorted(x for _, g, x in rows if not keys or g == r.lang)
            assert r.rows == len(xs)
            for k in (1, 2, 3):
                exact = xs[math.ceil(len(xs) * k / 4) - 1]  # the first value that a quarter reaches
                assert r[f"q{k}"] == pytest.approx(exact, rel=0.01)


def test_preference_weights_minimise_the_loss_over_all_pairs():
    rng = np.random.default_rng(2)
    y = (rng.random(60) < 0.5).astype(float)
    x = rng.normal(size=(60, len(pairwise_quality.NAMES)))
    x[:, 1] += 0.8 * y
    x[:, 4] -= 0.5 * y
    model = pairwise_quality.trained(x, y)
    z = np.clip((x - x.mean(0)) / x.std(0), -6, 6)
    d = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, z.shape[1])  # every pair, once

    def loss(w):
        return np.logaddexp(0, -d @ w).mean() + 5e-4 * w @ w

    w = np.zeros(z.shape[1])
    for _ in range(4000):
        p = 1 / (1 + np.exp(d @ w))
        w -= 0.5 * (-(d * p[:, None]).mean(0) + 1e-3 * w)
    # the operator draws its pairs, so it comes near the best loss over all of them
    assert loss(w) <= loss(model["weights"]) <= loss(w) + 0.02
    strength = np.sort(z @ model["weights"])
    assert model["cut"] == pytest.approx(strength[(y == 0).sum() - 1 : (y == 0).sum() + 1].mean())


def test_toxic_features_equal_sums_over_all_pairs_of_hits():
    terms = [("stupid", 1.0), ("awful", 0.6), ("rotten", 0.4)]
    matcher = toxic_terms.Matcher(terms)
    rng = random.Random(8)
    words = ["stupid", "stpid", "awful", "awfull", "rotten", "calm", "tree", '"said', 'so"', '"awful"', "river", "stone"]
    known = {"stupid": (0, 0), "stpid": (0, 1), "awful": (1, 0), "awfull": (1, 1), "rotten": (2, 0), '"awful"': (1, 0)}
    for _ in range(300):
        text = [rng.choice(words) for _ in range(rng.randint(1, 60))]
        hits = [(k, known[w]) for k, w in enumerate(text) if w in known]
        weight = {k: terms[t][1] * (1.0, 0.5, 0.3)[e] for k, (t, e) in hits}
        quoted = set()
        for k, _ in hits:
            before = text[max(0, k - toxic_terms.CLOSE) : k + 1]
            after = text[k : k + toxic_terms.CLOSE + 1]
            if any(w.startswith('"') for w in before) and any(w.endswith('"') for w in after):
                quoted.add(k)
        plain = sum(weight[k] for k, (_, e) in hits if k not in quoted and not e)
        fuzzy = sum(weight[k] for k, (_, e) in hits if k not in quoted and e)
        near = [sum(weight[j] for j in weight if abs(j - k) <= toxic_terms.CONTEXT) for k, _ in hits if k not in quoted]
        want = [plain, sum(weight[k] for k in quoted), fuzzy, max(near, default=0), len(hits)]
        want = [math.log1p(v) for v in want] + [min(1.0, 10 * len(hits) / len(text))]
        assert matcher.features(" ".join(text)) == pytest.approx(want if hits else [0.0] * 6)

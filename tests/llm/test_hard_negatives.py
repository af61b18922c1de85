"""Hard negatives against comparing all pairs, over many cells and on odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tillcast.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, anchor long, w int, size int, at int, i int, j int"


def plain(rows):
    """By all pairs in whole numbers; rows are (vec_id, vector, label)."""
    known = []
    for vec_id, x, label in rows:
        if None in (vec_id, x, label) or any(c is None or not math.isfinite(c) or abs(c) >= 65536 for c in x):
            continue
        known.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * c) for c in x]))
    asked = {(i, label, tuple(v)) for i, label, v in known if i % 50 == 0}
    out = []
    for i, label, v in asked:
        scored = [(-sum(a * b for a, b in zip(v, y)), k, m) for k, m, y in known if k != i and len(y) == len(v)]
        for s, p, _ in sorted(x for x in scored if x[2] == label)[:5]:
            fits = sorted((n, k) for n, k, m in scored if m != label and 50 * -s <= 100 * -n <= 95 * -s)
            out += [(i, p, r + 1, k, -s, -n) for r, (n, k) in enumerate(fits[:3])]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in rows], SCHEMA)
    return sorted(map(tuple, hard_negatives.mined(df).collect()))


@pytest.mark.parametrize("kind", ["random", "near", "skewed"])
def test_equals_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "ROWS", 150)
    rng = np.random.default_rng(3)
    n, d = 1200, 24
    x = rng.normal(size=(n, d))
    if kind == "near":
        x = x[rng.integers(0, 40, n)] + 0.3 * x
    if kind == "skewed":  # few heavy dimensions, many rows of one label, ties
        x = np.round(x * 2.0 ** -np.arange(d), 2)
    label = np.where(rng.random(n) < 0.6, 1, rng.integers(0, 10, n))
    rows = [(k, x[k].tolist(), int(label[k])) for k in range(n)]
    want = plain(rows)
    assert mined(spark, rows) == want and len(want) > 100


def test_the_steps_and_the_index_lose_nothing(monkeypatch):
    rng = np.random.default_rng(8)
    for d in (1, 3, 17):
        q, x = (rng.integers(-300, 300, (k, d)).astype(np.int32) for k in (40, 500))
        ids = rng.permutation(500)
        low = rng.integers(-20_000, 120_000, (40, 4))
        high = low + rng.integers(-5_000, 40_000, (40, 4))
        monkeypatch.setattr(hard_negatives, "PAIRS", 500 * 9)
        found = hard_negatives._best(q, None, x, ids, low, high, lambda a, b: (a + b) % 3 > 0, 2)
        got = sorted(t for part in found for t in zip(*(c.tolist() for c in part)))
        score = q.astype(np.int64) @ x.T.astype(np.int64)
        want = []
        for a in range(40):
            for w in range(4):
                fits = [(-score[a, b], ids[b], b) for b in range(500) if low[a, w] <= score[a, b] <= high[a, w] and (a + b) % 3]
                want += [(a, w, b, -s) for s, _, b in sorted(fits)[:2]]
        assert got == sorted(want)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.7, 0.3], 2), (3, [0.7, 0.3], 3), (3, [0.7, 0.3], 3),
        (50, [0.0, 0.0], 1), (100, [1.0, 0.5], 2), (100, [1.0, 0.5], 2), (100, [0.5, 1.0], 1), (150, None, 1),
        (200, [nan, 1.0], 1), (250, [1.0, None], 1), (300, [1.0, 1.0], None), (None, [1.0, 1.0], 1),
        (4, [inf, 1.0], 1), (5, [1e30, 1.0], 1), (400, [1.0, 0.0, 0.0], 1), (401, [1.0, 0.1, 0.0], 1), (402, [0.8, 0.1, 0.0], 2),
        (450, [], 1), (451, [], 1), (452, [], 2), (500, [-1.0, 0.0], 4), (501, [1.0, 0.0], 4), (-50, [0.6, 0.6], 1),
    ]
    want = plain(rows)
    assert mined(spark, rows) == want and {r[0] for r in want} >= {0, 50, 100, 400, 450}
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(k, [1.0], 1) for k in range(1, 9)]) == []

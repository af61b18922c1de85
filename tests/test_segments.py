"""Bounded segments of large groups, against plain Python."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tillcast.operators.aggregates import weekday_stats
from tillcast.operators.segments import exact_quantiles, scan_by_key, segmented


def skewed(spark, n=6000):
    """One key with a third of the rows and many ties, small keys, a null key and null values."""
    rng = random.Random(5)
    rows = [(1, float(rng.randint(0, 40))) for _ in range(n // 2)]
    rows += [(rng.randint(2, 90), round(rng.gauss(0, 9), 3)) for _ in range(n // 2)]
    rows += [(None, 4.0), (None, 8.0), (91, None), (92, 5.0), (93, -0.0), (93, 0.0)]
    return rows, spark.createDataFrame(rows, "k int, x double").repartition(4)


@pytest.mark.parametrize("rows", [1, 7, 250, 100_000])
def test_exact_quantiles_equal_interpolation(spark, rows):
    plain, df = skewed(spark, 1200 if rows == 1 else 6000)
    shares = {"low": 0.0, "q1": 0.25, "mid": 0.5, "q9": 0.9, "top": 1.0}
    got = {r.k: r for r in exact_quantiles(df, ["k"], "x", shares, rows).collect()}
    assert set(got) == {k for k, _ in plain}
    for key in got:
        xs = sorted(x for k, x in plain if k == key and x is not None)
        for name, share in shares.items():
            if not xs:
                assert got[key][name] is None
                continue
            at = share * (len(xs) - 1)
            low, high = xs[math.floor(at)], xs[math.ceil(at)]
            assert got[key][name] == pytest.approx(low + (high - low) * (at - math.floor(at)))
    assert exact_quantiles(df.limit(0), ["k"], "x", shares).count() == 0


def test_segments_are_ordered_and_bounded(spark):
    _, df = skewed(spark)
    cut = segmented(df, ["k"], ["x"], rows=100)
    sizes = cut.groupBy("k", "_segment").agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b"))
    sizes = sorted(sizes.where("k = 1").collect(), key=lambda r: r["_segment"])
    assert len(sizes) >= 30 and max(r.n for r in sizes) <= 100
    assert all(a.b <= b.a for a, b in zip(sizes, sizes[1:]))


def test_a_scan_meets_no_whole_group(spark):
    n, most = 200_000, 5_000
    df = spark.range(n).select((F.col("id") % 50 == 0).cast("int").alias("k"), "id", (F.col("id") % 7).alias("q"))

    def running(segment):
        before = segment["before"].fillna(0)
        return segment.assign(total=before + segment["q"].cumsum(), seen=len(segment))[["k", "id", "total", "seen"]]

    sums = {"before": (F.sum("q"), F.sum)}
    out = scan_by_key(df, ["k"], ["id"], sums, running, "k int, id long, total long, seen long", most)
    assert out.agg(F.max("seen")).first()[0] <= most
    total = {0: 0, 1: 0}
    for r in out.orderBy("id").collect():
        total[r.k] += r.id % 7
        assert r.total == total[r.k]


def test_weekday_statistics_of_a_skewed_store_without_a_buffer(spark):
    rng = random.Random(9)
    rows = [(1, 0, rng.random()) for _ in range(4000)] + [(s, s % 6, float(s)) for s in range(2, 40)]
    df = spark.createDataFrame(rows, "location_num int, weekday int, demand double")
    plan = weekday_stats(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "median(" not in plan
    columns = ["min_value", "max_value", "mean", "median", "std", "iqr"]
    got, want = (
        {(r.location_num, r.weekday): [r[c] for c in columns] for r in weekday_stats(df, bounded=b).collect()}
        for b in (False, True)
    )
    assert set(got) == set(want)
    for key, values in want.items():
        assert got[key] == [pytest.approx(v) if v is not None else None for v in values]

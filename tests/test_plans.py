"""Composite plans on small series and the invariants of the checks."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
from pyspark.sql import functions as F

from tillcast.operators.snapshot import current, dedupe_latest, latest_snapshot, newest_versions
from tillcast.plans import (
    breakdown,
    document_checks,
    forecast_checks,
    imputation,
    limits,
    naive,
    scoring,
)

D = date
SAT_OFF = "location_num int"
FLAGS = [
    "aroundthanksgiving",
    "aroundchristmas",
    "onedaypriorchristmas_and_new_year",
    "federalholiday",
    "holiday",
    "blackfridaycheck",
]


def series(spark, values, start=D(2001, 1, 1), store=1):
    data = [
        (store, start + timedelta(i), (start + timedelta(i)).isoweekday(), float(x))
        for i, x in enumerate(values)
    ]
    df = spark.createDataFrame(
        data, "location_num int, business_date date, dayofweek int, x double"
    )
    return df.withColumns({f: F.lit(0) for f in FLAGS})


def values_of(df):
    return [r.x for r in df.orderBy("business_date").collect()]


def no_saturdays(spark):
    return spark.createDataFrame([], SAT_OFF)


def test_zeros_become_the_weekday_median(spark):
    raw = [10.0] * 60
    raw[0], raw[7], raw[14] = 0.0, 20.0, 30.0
    raw[6], raw[57] = 0.0, 0.0  # a Sunday, and a day after the head
    out = values_of(imputation.impute_zeros(series(spark, raw), ["location_num"], "x"))
    assert out[0] == 10.0 and out[6] == 0.0 and out[57] == 0.0


def test_outliers_against_all_days(spark):
    raw = [10.0 + i % 3 for i in range(56)] + [500.0]
    raw[1] = 300.0
    out = values_of(
        imputation.impute_outliers(series(spark, raw), ["location_num"], "x", no_saturdays(spark))
    )
    tuesdays = sorted(raw[i] for i in range(8, 56, 7))
    assert out[1] == float(np.median(tuesdays)) and out[56] == 500.0


def test_weekday_fences_and_audit(spark):
    raw = [10.0 * (1 + i % 7) for i in range(56)]
    raw[2] = 999.0
    clean, audit = imputation.impute_outliers_by_weekday(
        series(spark, raw), ["location_num"], "x", no_saturdays(spark)
    )
    assert values_of(clean)[2] == 30.0
    found = audit.collect()
    assert [(r.actuals, r.imputed_actuals) for r in found] == [(999.0, 30.0)]


def test_nothing_is_imputed_without_sales(spark):
    raw = [0.0] * 60
    clean, audit = imputation.impute_outliers_by_weekday(
        series(spark, raw), ["location_num"], "x", no_saturdays(spark)
    )
    assert values_of(clean) == raw and audit.count() == 0


def brute_backfill(raw, start):
    out, gap = list(raw), min(len(raw) - 88, 25)
    if gap <= 0:
        return out
    end = len(raw) - 1 - 32
    weekday = (start + timedelta(end)).isoweekday()
    source = max(i for i in range(56) if (start + timedelta(i)).isoweekday() == weekday)
    for k in range(gap):
        out[end - k] = raw[source - k]
    return out


def test_gap_backfill_lengths(spark):
    start = D(2001, 1, 1)
    for n in (88, 95, 120):
        raw = [float(i) for i in range(n)]
        got = imputation.backfill_gap(series(spark, raw, start), ["location_num"], "x")
        assert values_of(got) == brute_backfill(raw, start), n


def test_one_pass_equals_the_steps(spark):
    rng = np.random.default_rng(4)
    parts = []
    for store, n in ((1, 88), (2, 95), (3, 130), (4, 40), (5, 57), (6, 90)):
        raw = np.where(rng.random(n) < 0.25, 0.0, np.round(rng.gamma(2, 5, n), 2))
        raw[rng.integers(0, n, 4)] *= 40
        if store == 6:
            raw[:] = 0
        part = series(spark, raw.tolist(), D(2000, 11, 20), store)
        holiday = F.when(F.dayofmonth("business_date") == 25, 1).otherwise(0)
        parts.append(part.withColumn("holiday", holiday).withColumn("aroundchristmas", holiday))
    df = parts[0]
    for part in parts[1:]:
        df = df.unionByName(part)
    off = spark.createDataFrame([(2,)], SAT_OFF)
    keys = ["location_num"]
    steps = imputation.impute_zeros(df, keys, "x")
    steps = imputation.backfill_gap(
        imputation.impute_outliers_by_weekday(steps, keys, "x", off)[0], keys, "x"
    )
    once = imputation.repair_series(df, keys, "x", off)
    assert once.columns == df.columns
    got, want = ({(r.location_num, r.business_date): r.x for r in d.collect()} for d in (once, steps))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert imputation.repair_series(df.limit(0), keys, "x", off).count() == 0


def test_a_control_table_reads_what_a_snapshot_reads(spark):
    start = D(2001, 1, 1)
    rows = [(s, start + timedelta(v), x) for s in range(1, 150) for v in (3, 10 + s % 4) for x in (1, 2)]
    rows += [(500, start - timedelta(900), 1), (500, start - timedelta(901), 2), (None, start, 3)]
    df = spark.createDataFrame(rows, "location_num int, generation_date date, x int")
    control = newest_versions(df, ["location_num"])
    want = sorted(map(tuple, latest_snapshot(df, keys=["location_num"]).collect()))
    assert sorted(map(tuple, latest_snapshot(df, keys=["location_num"], control=control).collect())) == want
    # a store closed for years does not move the bound: its rows are named
    plan = current(df, control)._jdf.queryExecution().optimizedPlan().toString()
    assert "500" in plan and ">= 2001-01-1" in plan
    assert latest_snapshot(df, keys=["location_num"], control=control.limit(0)).count() == 0
    # kept from load to load; late and repeated loads change nothing
    kept = newest_versions(df.where("x = 1"), ["location_num"])
    for load in (df.where("x = 2"), df.where("generation_date < '2001-01-05'"), df.where("x = 1")):
        kept = newest_versions(load, ["location_num"], control=kept)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(map(tuple, control.collect()), key=repr)


def linear(row):
    return float(row.sum() / len(row))


def test_recursive_scoring_matches_a_plain_loop(spark):
    raw = [float(10 + (i * 5) % 13) for i in range(88)]
    df = series(spark, raw)
    med, iqr = [9.0, 4.0], [3.0, 0.0]
    got = scoring.score_recursive(
        df, ["location_num"], "x", ["dayofweek"], linear, med, iqr, no_saturdays(spark)
    )
    got = [r.forecast for r in got.orderBy("business_date").collect()]
    x = list(raw)
    dow = [(D(2001, 1, 1) + timedelta(i)).isoweekday() for i in range(88)]
    for t in range(56, 88):
        if dow[t] == 7:
            x[t] = 0.0
            continue
        cells = []
        for i in range(t - 24, t + 1):
            if i < t - 9:
                cells.append((x[i] - 9.0) / 3.0)
            cells.append(float(dow[i]))
        x[t] = max(0.0, sum(cells) / len(cells) * 3.0 + 9.0)
    assert np.allclose(got, x[56:])


def test_short_series_are_not_scored(spark):
    df = series(spark, [1.0] * 55)
    got = scoring.score_recursive(
        df, ["location_num"], "x", ["dayofweek"], linear, [0, 0], [1, 1], no_saturdays(spark)
    )
    assert got.count() == 0


def test_every_series_is_scored_or_gated(spark):
    def named(n, last, store):
        start = last - timedelta(n - 1)
        return series(spark, [float(5 + i % 9) for i in range(n)], start).withColumn("location_num", F.lit(store))

    as_of = D(2001, 7, 1)
    df = named(56, D(2001, 8, 1), 1).unionByName(named(57, D(2001, 8, 1), 2))
    # first days to forecast 6 and 7 days before the run date
    df = df.unionByName(named(88, D(2001, 7, 26), 3)).unionByName(named(88, D(2001, 7, 25), 4))
    df = df.unionByName(named(10, D(2001, 1, 1), 5))
    args = (["location_num"], "x", ["dayofweek"], linear, [9.0, 4.0], [3.0, 0.0], no_saturdays(spark))
    scored, gated = scoring.score_gated(df, *args, as_of)
    assert sorted(map(tuple, gated.collect())) == [(1, 56, "short"), (5, 10, "short")]
    got = {}
    for r in scored.collect():
        got.setdefault(r.location_num, {})[r.business_date] = r.forecast
    assert {k: len(v) for k, v in got.items()} == {2: 32, 3: 32, 4: 32}
    assert max(got[4]) == D(2001, 7, 25) and set(got[4].values()) == {0.0}
    assert any(got[2].values()) and any(got[3].values())
    plain = scoring.score_recursive(df.where("location_num in (2, 3)"), *args)
    assert {(r.location_num, r.business_date): r.forecast for r in plain.collect()} == {
        (k, d): x for k in (2, 3) for d, x in got[k].items()
    }


def test_items_without_ratio_are_spread_evenly(spark):
    forecast = spark.createDataFrame(
        [(1, D(2001, 7, 18), 5, 130.0, D(2001, 7, 1)), (1, D(2001, 7, 18), 6, 50.0, D(2001, 7, 1))],
        "location_num int, business_date date, item_id int, forecast double, generation_date date",
    )
    ratios = spark.createDataFrame(
        [(1, D(2001, 7, 18), 6, "10:00:00", 0.25), (1, D(2001, 7, 18), 6, "10:15:00", 0.75)],
        "location_num int, business_date date, product int, time string, ratio double",
    )
    out = breakdown.breakdown_items(forecast, ratios, no_saturdays(spark), D(2001, 7, 1))
    even = {r.timequarter: float(r.min15_forecast) for r in out.where("product = 5").collect()}
    assert len(even) == 96 and sum(even.values()) == 130.0
    assert [even[t] for t in ("05:45:00", "06:00:00", "22:00:00", "22:15:00")] == [0, 2, 2, 0]
    split = {r.timequarter: float(r.min15_forecast) for r in out.where("product = 6").collect()}
    assert split == {"10:00:00": 12.5, "10:15:00": 37.5}


def test_naive_forecast_fills_missing_days(spark):
    as_of = D(2001, 7, 1)
    sales = spark.createDataFrame(
        [(1, 5, as_of - timedelta(2 + i), 6.0) for i in range(16)],
        "location_num int, product int, business_date date, sum_daily_quantity double",
    )
    pairs = spark.createDataFrame([(1, 5)], "location_num int, product int")
    none = spark.createDataFrame([(as_of + timedelta(16),)], "business_date date")
    out = naive.naive_forecast(sales, pairs, none, as_of)
    got = {r.business_date: (r.horizon, r.forecast) for r in out.collect()}
    seen = [0.0] * 14 + [6.0] * 16
    for _ in range(34):
        tail = sorted(seen[-30:])
        seen.append((tail[14] + tail[15]) / 2)
    expected = {as_of + timedelta(n): seen[30 + n + 1] for n in range(16, 30) if n != 20}
    expected[as_of + timedelta(16)] = 0.0  # a holiday
    assert {d: f for d, (_, f) in got.items()} == expected
    assert got[as_of + timedelta(25)][0] == "redundancy"


def flags(spark, amounts):
    data = [
        (1, D(2001, 7, 18), "3", f"{i:02d}", float(x)) for i, x in enumerate(amounts)
    ]
    df = spark.createDataFrame(
        data,
        "location_num int, business_date date, servicetype string, intervalstart string, v double",
    )
    seen = ["servicetype", "intervalstart"]
    return document_checks.flat_flags(df, "v", "flat", seen).first().flat


def test_flat_forecast_needs_two_values_and_65_of_the_second(spark):
    assert flags(spark, [0] * 24 + [2] * 65 + [0] * 7) == 1
    assert flags(spark, [2] * 65 + [0] * 31) == 0  # 65 of the first value
    assert flags(spark, [0] * 24 + [2] * 64 + [0] * 8) == 0
    assert flags(spark, [0] * 24 + [2] * 64 + [3] + [0] * 7) == 0


def test_limit_bands(spark):
    weekday, sunday = D(2001, 7, 18), D(2001, 7, 22)
    totals = spark.createDataFrame(
        [(i, weekday, "m", t, t) for i, t in enumerate([58.5, 58.6, 65.0, 65.1, 135.0, 202.4, 202.5])]
        + [(50, sunday, "m", 0.0, 0.0), (51, sunday, "m", 0.0, 1.0)],
        "location_num int, business_date date, metric string, total double, sunday_total double",
    )
    limits = totals.selectExpr(
        "location_num", "weekday(business_date) weekday", "metric", "100D median"
    ).distinct()
    out = document_checks.limit_flags(totals, limits).collect()
    got = {r.location_num: (r.failed, r.warned) for r in out}
    assert got == {
        0: (1, 0), 1: (0, 1), 2: (0, 1), 3: (0, 0), 4: (0, 1), 5: (0, 1), 6: (1, 0),
        50: (0, 0), 51: (1, 0),
    }


def check(spark, data):
    return spark.createDataFrame(
        [(s, q, D(2001, 7, 1)) for s, q in data],
        "location_num int, forecast_qc int, generation_date date",
    )


def test_passed_and_failed_stores(spark):
    items = check(spark, [(1, 1), (2, 1), (3, 0), (4, 1)])
    metrics = check(spark, [(1, 1), (2, 0), (3, 1), (None, 0), (5, 1)])
    failed = forecast_checks.failed_stores([items], [metrics])
    assert sorted(r.location_num for r in failed.collect()) == [0, 2, 3]
    passed = forecast_checks.passed_stores([items], [metrics])
    assert [r.store_number for r in passed.collect()] == ["00001"]


def test_a_null_store_failing_an_item_check_empties_the_list(spark):
    items = check(spark, [(1, 1), (None, 0)])
    metrics = check(spark, [(1, 1)])
    assert forecast_checks.passed_stores([items], [metrics]).count() == 0


def test_baseline_list_leaves_modelled_stores_out(spark):
    items, metrics = check(spark, [(1, 1), (2, 1)]), check(spark, [(1, 1), (2, 1)])
    modelled = spark.createDataFrame([(2,)], "location_num int")
    out = forecast_checks.passed_stores([items], [metrics], modelled)
    assert [r.store_number for r in out.collect()] == ["00001"]


def test_missing_documents_skip_closed_days(spark):
    stores = spark.createDataFrame([(1,), (3,)], "location_num int")
    off = spark.createDataFrame([(3,)], SAT_OFF)
    dates = [D(2001, 7, 20), D(2001, 7, 21), D(2001, 7, 22)]
    delivered = spark.createDataFrame(
        [(1, D(2001, 7, 20))], "location_num int, business_date date"
    )
    out = document_checks.missing_documents(stores, dates, delivered, off)
    assert sorted(tuple(r) for r in out.collect()) == [(1, D(2001, 7, 21)), (3, D(2001, 7, 20))]


def test_one_store_with_most_rows_gives_the_same_answers(spark):
    start = D(2001, 1, 1)
    data = [
        (store, start + timedelta(i % 90), float(i % 7 + 1), start + timedelta(i % 90 + 1 + i % 2))
        for store, n in ((1, 4000), (2, 180), (3, 90))
        for i in range(n)
    ]
    df = spark.createDataFrame(
        data, "location_num int, business_date date, x double, generation_date date"
    ).repartition(4)
    newest = {}
    for s, _, _, g in data:
        newest[s] = max(newest.get(s, g), g)
    kept = sorted((s, d, x) for s, d, x, g in data if g == newest[s])
    got = latest_snapshot(df, keys=["location_num"])
    assert sorted((r.location_num, r.business_date, r.x) for r in got.collect()) == kept

    per_day = {}
    for s, d, _, g in data:
        per_day[s, d] = max(per_day.get((s, d), g), g)
    versions = sorted({(s, d, x) for s, d, x, g in data if g == per_day[s, d]})
    got = dedupe_latest(df, ["location_num", "business_date"], ["x"])
    assert sorted((r.location_num, r.business_date, r.x) for r in got.collect()) == versions

    calendar = spark.createDataFrame(
        [(D(2001, 3, 1), 1, "Spring")], "business_date date, holiday int, federalholiday_name string"
    )
    demand = {}
    for s, d, x, g in data:
        if g == per_day[s, d]:
            demand[s, d] = demand.get((s, d), 0.0) + x
    wanted = set()
    for s in (1, 2, 3):
        recent = sorted((d for t, d in demand if t == s), reverse=True)[:56]
        wanted |= {
            (s, d, demand[s, d]) for d in recent if d.weekday() != 6 and d != D(2001, 3, 1)
        }
    got = limits.daily_demand(df, calendar, "x", 56)
    assert {(r.location_num, r.business_date, r.demand) for r in got.collect()} == wanted

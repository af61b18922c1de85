"""Edge rows per operator: ties, NULLs, empty and one-row groups, odd dates."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tillcast.functions import calendar as C
from tillcast.functions import numeric as N
from tillcast.functions import text as T
from tillcast.functions.series import recursive_median, trailing_days
from tillcast.operators import aggregates as A
from tillcast.operators import joins as J
from tillcast.operators import predicates as P
from tillcast.operators import sets as U
from tillcast.operators import snapshot as S
from tillcast.operators import windows as W

D = date


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def one(spark, column):
    return spark.range(1).select(column).first()[0]


# -- functions -----------------------------------------------------------------


def test_store_numbers_are_padded_but_never_cut(spark):
    df = spark.createDataFrame([(7,), (12,), (123456,)], "n int")
    padded = df.select(T.pad_store(F.col("n")).alias("p"))
    assert rows(padded, "p") == [("00007",), ("00012",), ("123456",)]
    assert one(spark, T.strip_zeros(F.lit("00012"))) == "12"


def test_last_year_date_special_stretches(spark):
    cases = {
        D(2000, 1, 15): D(1999, 1, 17),
        D(2000, 2, 29): D(1999, 3, 2),
        D(2001, 3, 1): D(2000, 3, 3),
        D(2001, 2, 28): D(2000, 3, 1),
        D(2024, 2, 29): D(2023, 3, 2),
        D(2023, 7, 4): D(2022, 7, 5),
        D(2025, 1, 10): D(2024, 1, 12),
    }
    for day, expected in cases.items():
        assert one(spark, C.last_year_date(F.lit(day))) == expected, day


def test_last_year_is_364_days_back_outside_the_stretches(spark):
    days = spark.sql("SELECT explode(sequence(date'1995-01-01', date'2029-12-31')) d")
    odd = days.where(F.datediff("d", C.last_year_date(F.col("d"))) != 364)
    found = {r.d for r in odd.collect()}
    first = {D(2000, 1, 1) + timedelta(n) for n in range(59)}
    second = {D(2001, 3, 1) + timedelta(n) for n in range(306)}
    assert found == first | second


def test_closed_holidays(spark):
    df = spark.sql("SELECT explode(sequence(date'2001-01-01', date'2001-12-31')) d")
    shut = df.where(C.is_closed_holiday(F.col("d")))
    assert rows(shut, "d") == [(D(2001, 11, 22),), (D(2001, 12, 25),)]


def test_quarter_hours_and_text_times(spark):
    grid = [r[0] for r in C.time_grid(spark).collect()]
    assert len(grid) == 96 and grid[0] == "00:00:00" and grid[-1] == "23:45:00"
    wall = F.lit("2001-03-01 05:45:00").cast("timestamp_ntz")
    assert one(spark, C.time_of_day(wall)) == "05:45:00"
    assert one(spark, C.interval_start(F.lit(D(2001, 3, 1)), F.lit("05:45:00"))) == (
        "2001-03-01T05:45:00"
    )


def test_business_today_follows_the_zone(spark):
    instant = F.lit("2024-01-02 03:00:00").cast("timestamp")
    assert one(spark, C.business_today(instant)) == D(2024, 1, 1)


def test_decimal_sum_orders_differ(spark):
    df = spark.createDataFrame([(1, 0.004), (1, 0.004)], "k int, x double")
    out = df.agg(N.dsum(F.col("x"), True).alias("a"), N.dsum(F.col("x"), False).alias("b")).first()
    assert (float(out.a), float(out.b)) == (0.0, 0.01)


def test_robust_scale_round_trip_and_zero_iqr(spark):
    x, m = F.lit(7.0), F.lit(3.0)
    scaled = N.robust_scale(x, m, F.lit(2.0))
    assert one(spark, scaled) == 2.0
    assert one(spark, N.robust_unscale(scaled, m, F.lit(2.0))) == 7.0
    assert one(spark, N.robust_scale(x, m, F.lit(0.0))) == 7.0


def test_setting_codes_and_defaults(spark):
    stores = spark.createDataFrame([(1,), (2,)], "location_num int")
    settings = spark.createDataFrame([(1, "4-week20")], "location_num int, naming_conv string")
    assert rows(P.parse_settings(stores, settings), "location_num") == [(1, 4, 0.2), (2, 5, 0.0)]


def test_document_paths(spark):
    for path in ("a/main/00012/demand-07-19-2001.json", "x/00012/demand=07-19-2001/part-0.json"):
        assert one(spark, T.document_store(F.lit(path))) == "00012"
        assert one(spark, T.document_date(F.lit(path))) == D(2001, 7, 19)


def test_trailing_days_fill_missing_days_with_zero(spark):
    day = date(2001, 3, 30)
    rows = [(1, day - timedelta(k), float(k)) for k in (0, 1, 5, 29, 30, 90)] + [(1, day, 2.0), (2, day, 7.0)]
    df = spark.createDataFrame(rows, "location_num int, business_date date, x double")
    got = {r.location_num: r.history for r in trailing_days(df, ["location_num"], "x").collect()}
    want = [0.0] * 30
    want[29], want[28], want[24], want[0] = 2.0, 1.0, 5.0, 29.0
    assert got == {1: want, 2: [0.0] * 29 + [7.0]}


def test_more_weeks_than_the_bound_fail(spark):
    rows = [(1, date(2001, 1, 1) + timedelta(7 * k), weeks) for k in range(20) for weeks in (12,)]
    df = spark.createDataFrame(rows, "k int, business_date date, lookup_weeks int")
    assert W.recent_same_weekday(df, ["k"], most_weeks=12).count() == 11
    with pytest.raises(Exception, match="lookup_weeks above 9: 12"):
        W.recent_same_weekday(df, ["k"]).count()


def test_recursive_median_matches_a_plain_loop(spark):
    history = [float((i * 7) % 11) for i in range(30)]
    seen = list(history)
    for _ in range(34):
        tail = sorted(seen[-30:])
        seen.append(max(0.0, (tail[14] + tail[15]) / 2))
    values = F.array(*[F.lit(x) for x in history])
    assert one(spark, recursive_median(values)) == seen


# -- snapshots ------------------------------------------------------------------


def test_latest_version_keeps_ties_and_folds_copies(spark):
    df = spark.createDataFrame(
        [
            (1, D(2001, 1, 1), 10, D(2001, 1, 2)),
            (1, D(2001, 1, 1), 11, D(2001, 1, 3)),
            (1, D(2001, 1, 1), 12, D(2001, 1, 3)),
            (1, D(2001, 1, 1), 12, D(2001, 1, 3)),
        ],
        "location_num int, business_date date, x int, generation_date date",
    )
    out = S.dedupe_latest(df, ["location_num", "business_date"], ["x"])
    assert sorted(r.x for r in out.collect()) == [11, 12]


def test_latest_snapshot_global_and_per_key(spark):
    df = spark.createDataFrame(
        [(1, D(2001, 1, 1)), (1, D(2001, 1, 2)), (2, D(2001, 1, 1))],
        "location_num int, generation_date date",
    )
    assert rows(S.latest_snapshot(df)) == [(1, D(2001, 1, 2))]
    per_key = S.latest_snapshot(df, keys=["location_num"])
    assert rows(per_key, "location_num") == [(1, D(2001, 1, 2)), (2, D(2001, 1, 1))]


def test_incremental_slice_needs_a_target_or_a_default(spark):
    schema = "location_num int, business_date date"
    initial = spark.createDataFrame([(1, D(2001, 1, 5)), (2, D(2001, 1, 3))], schema)
    final = spark.createDataFrame([(1, D(2001, 1, 3))], schema)
    calendar = spark.sql(
        "SELECT explode(sequence(date'2001-01-01', date'2001-01-31')) business_date"
    )
    known = S.incremental_slice(calendar, S.incremental_bounds(final, initial))
    assert sorted(tuple(r) for r in known.select(*schema.split()[::2]).collect()) == [
        (1, D(2001, 1, 4)),
        (1, D(2001, 1, 5)),
    ]
    bounds = S.incremental_bounds(final, initial, default=D(2001, 1, 1))
    assert S.incremental_slice(calendar, bounds).where("location_num = 2").count() == 2


def test_gap_stores(spark):
    df = spark.createDataFrame(
        [
            (1, D(2001, 1, 1)), (1, D(2001, 1, 31)),
            (2, D(2001, 1, 20)), (2, D(2001, 1, 31)),
            (3, D(2001, 1, 1)),
        ],
        "location_num int, generation_date date",
    )
    assert [r.location_num for r in S.gap_stores(df).collect()] == [1]


def test_top_n_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 k", "id v").repartition(4)
    out = S.top_n_by(df, ["k"], [F.desc("v")], 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(r.v for r in out.collect()) == [994, 995, 996, 997, 998, 999]


# -- predicates ------------------------------------------------------------------


def test_all_zero_rows_go_and_null_rows_stay(spark):
    df = spark.createDataFrame([(0, 0), (0, None), (None, None), (0, 1)], "a int, b int")
    out = P.drop_all_zero(df, ["a", "b"])
    assert sorted(map(tuple, out.collect()), key=repr) == [(0, 1), (0, None), (None, None)]


def test_closed_days_are_masked(spark):
    df = spark.createDataFrame(
        [(s, d, 5.0) for s in (1, 3) for d in (D(2001, 7, 20), D(2001, 7, 21), D(2001, 7, 22))],
        "location_num int, business_date date, forecast double",
    )
    off = spark.createDataFrame([(3,), (3,)], "location_num int")
    out = P.mask_closed(df, off, ["forecast"])
    kept = {(r.location_num, r.business_date.day) for r in out.collect() if r.forecast}
    assert kept == {(1, 20), (1, 21), (3, 20)} and out.count() == 6


def test_store_status_order(spark):
    no, today = P.NO_DATE, D(2001, 7, 1)

    def ahead(n):
        return today + timedelta(days=n)

    cases = [
        (1, no, no, no, no, 1),  # nothing planned
        (2, ahead(10), ahead(10), ahead(40), no, 1),  # closes later
        (3, ahead(-30), ahead(-30), ahead(30), no, 99),  # closed, reopens in 30 days
        (4, ahead(-60), ahead(-60), ahead(-10), no, 0),  # reopened 10 days ago
        (5, ahead(-100), ahead(-100), ahead(-26), no, 1),  # long open again
        (6, ahead(-30), no, ahead(30), no, 1),  # closed without a projection
        (7, ahead(-60), ahead(-60), ahead(15), no, 0),  # reopens within 20 days
        (8, ahead(-60), ahead(-60), no, no, 1),  # sentinel reopen is long past
    ]
    schema = (
        "location_num int, remodelclosedate date, remodelprojectedclosedate date, "
        "remodelreopendate date, remodelprojectedreopendate date"
    )
    df = spark.createDataFrame([c[:5] for c in cases], schema)
    got = {r.location_num: r.status for r in P.store_status(df, today).collect()}
    assert got == {c[0]: c[5] for c in cases}


def test_minimum_history_counts_rows(spark):
    df = spark.range(113).selectExpr("CASE WHEN id < 56 THEN 1 ELSE 2 END k", "id")
    assert {r.k for r in P.min_history(df, ["k"]).collect()} == {2}


# -- joins -------------------------------------------------------------------------


def test_not_in_follows_sql_null_rules(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    empty = spark.createDataFrame([], "v int")
    plain = spark.createDataFrame([(2,), (2,)], "v int")
    holed = spark.createDataFrame([(2,), (None,)], "v int")
    for listed in (empty, plain, holed):
        listed.createOrReplaceTempView("listed")
        df.createOrReplaceTempView("df")
        wanted = spark.sql("SELECT * FROM df WHERE k NOT IN (SELECT v FROM listed)")
        got = J.not_in(df, "k", listed)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(
            map(tuple, wanted.collect()), key=repr
        )


def test_full_join_equals_left_union_right(spark):
    a = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, x string")
    b = spark.createDataFrame([(2, "c"), (3, "d")], "k int, y string")
    left = a.join(b, "k", "left").select("k", "x", "y")
    right = a.join(b, "k", "right").select("k", "x", "y")
    got = J.full_join(a, b, ["k"]).select("k", "x", "y")
    assert set(map(tuple, got.collect())) == set(map(tuple, left.union(right).collect()))
    assert got.count() == 3


def test_scaffold_has_no_join(spark):
    df = J.scaffold(spark.range(3), [D(2001, 1, 1), D(2001, 1, 2)], intervals=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and df.count() == 3 * 2 * 96


def test_range_join_keeps_empty_windows(spark):
    facts = spark.createDataFrame(
        [(1, D(2001, 1, 1), 5), (1, D(2001, 1, 2), 6), (1, D(2001, 1, 8), 7)],
        "location_num int, business_date date, x int",
    )
    windows = spark.createDataFrame(
        [
            (1, D(2001, 1, 8), D(2001, 1, 1), D(2001, 1, 8)),
            (2, D(2001, 1, 8), D(2001, 1, 1), D(2001, 1, 8)),
        ],
        "location_num int, prediction_date date, ly_min_date date, ly_fiscal_date date",
    )
    out = J.range_lookback_join(facts, windows)
    assert sorted((r.location_num, r.x or 0) for r in out.collect()) == [(1, 5), (2, 0)]


# -- aggregates and windows ----------------------------------------------------------


def test_extremes_go_with_their_ties(spark):
    df = spark.createDataFrame(
        [(1, 1), (1, 1), (1, 2), (1, 3), (1, 9), (2, 5), (3, 4), (3, 6)], "k int, x int"
    )
    assert rows(W.trim_extremes(df, ["k"], "x"), "x") == [(1, 2), (1, 3)]


def test_rank_cut_keeps_ties(spark):
    df = spark.createDataFrame(
        [(1, D(2001, 1, d), 3) for d in (1, 8, 8, 15)],
        "k int, business_date date, lookup_weeks int",
    )
    assert W.recent_same_weekday(df, ["k"]).count() == 1 + 2


def test_low_medians_are_repaired(spark):
    demand = spark.createDataFrame(
        [(1, w, float(v)) for w, v in ((0, 100), (1, 100), (2, 0), (3, 10), (4, 120), (6, 3))],
        "location_num int, weekday int, demand double",
    )
    out = {r.weekday: r.median for r in A.repair_medians(A.weekday_stats(demand)).collect()}
    # Non-zero medians 100, 100, 10, 120, 3: typical 100, floor 15; weekday 5 is missing.
    assert out == {0: 100.0, 1: 100.0, 2: 100.0, 3: 100.0, 4: 120.0, 5: 100.0, 6: 100.0}


def test_store_without_any_demand_keeps_zero_medians(spark):
    demand = spark.createDataFrame([(1, 0, 0.0)], "location_num int, weekday int, demand double")
    out = A.repair_medians(A.weekday_stats(demand))
    assert sorted((r.weekday, r.median) for r in out.collect()) == [(w, 0.0) for w in range(6)]


def test_flag_counts_count_a_store_once(spark):
    df = spark.createDataFrame(
        [(D(2001, 1, 1), 1, 1), (D(2001, 1, 1), 1, 1), (D(2001, 1, 1), 2, 0), (D(2001, 1, 2), 2, 0)],
        "business_date date, location_num int, f int",
    )
    out = A.flag_counts(df, {"f": F.col("f") == 1})
    assert rows(out, "business_date") == [(D(2001, 1, 1), 1), (D(2001, 1, 2), 0)]


def test_one_hot_has_fixed_columns(spark):
    df = spark.createDataFrame([("a",), ("z",)], "c string")
    assert rows(U.one_hot(df, "c", ["a", "b"]), "c") == [("a", 1, 0), ("z", 0, 0)]

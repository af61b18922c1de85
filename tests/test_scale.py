"""Shared steps of the catalogue: results as before, and shuffles no wider than the input."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from catalog.views import AS_OF, DAY, GEN, LOC, Views
from tillcast.functions.calendar import HORIZONS
from tillcast.plans import delivery


def _exchanges(df):
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [line for line in lines if "Exchange hashpartitioning" in line]


def test_ingredients_shuffle_items_and_not_recipe_lines(spark):
    items = spark.sql(
        "SELECT * FROM VALUES (1, 1, DATE '2000-07-18', 'a', 2.00BD), (1, 2, DATE '2000-07-18', 'a', 3.00BD), "
        "(1, 1, DATE '2000-07-18', 'a', 2.00BD), (2, 1, DATE '2000-07-18', 'b', null), "
        "(null, 1, null, null, 1.00BD), (1, 9, DATE '2000-07-18', 'a', 5.00BD), (1, null, DATE '2000-07-18', 'a', 5.00BD) "
        f"AS t({LOC}, product, {DAY}, timequarter, sum_daily_quantity)"
    )
    v = Views(spark, "unused")
    v.__dict__["recipe"] = spark.sql(
        "SELECT * FROM VALUES (1, 5, 0.5D, 'EA'), (1, 6, 2.0D, 'LB'), (2, 5, 1.0D, 'EA') "
        "AS t(pin, ingredient_id, ingredient_quantity, unit_of_measure)"
    )
    used = v._ingredients(items, "timequarter")
    assert len(_exchanges(used)) == 1 and "ingredient_id" not in _exchanges(used)[0]
    day = date(2000, 7, 18)
    assert sorted(((r[LOC], r[DAY], r["timequarter"], r["ingredient_id"], r["_used"]) for r in used.collect()), key=repr) == sorted(
        [(1, day, "a", 5, 5.0), (1, day, "a", 6, 8.0), (2, day, "b", 5, None), (2, day, "b", 6, None),
         (None, None, None, 5, 0.5), (None, None, None, 6, 2.0)],
        key=repr,
    )


def test_sales_count_orders_behind_one_shuffle(spark):
    lines = spark.sql(
        "SELECT * FROM VALUES (1, DATE '2000-07-18', 7, 1.10BD), (1, DATE '2000-07-18', 7, 1.10BD), "
        "(1, DATE '2000-07-18', 8, null), (1, DATE '2000-07-18', null, 2.00BD), (null, null, 7, 1.00BD) "
        f"AS t({LOC}, {DAY}, order_num, price)"
    ).withColumn(GEN, F.col(DAY))
    sales = Views(spark, "unused")._sales(lines)
    assert len(_exchanges(sales)) == 1
    got = {(r[LOC], str(r["sales_sub_total"]), str(r["trans_count"])) for r in sales.collect()}
    assert got == {(1, "4.20", "2.00"), (None, "1.00", "1.00")}


def test_forecast_dates_are_cut_before_the_runs(spark):
    start = date(2000, 7, 1)
    facts = spark.range(27 * 60).selectExpr(
        f"cast(id % 27 + 1 as int) {LOC}", f"date_add(DATE '2000-07-01', cast(id div 27 as int)) {DAY}",
        f"DATE '2000-07-01' {GEN}",
    )
    for horizon, (first, last) in HORIZONS.items():
        ahead = Views(spark, "unused")._ahead(facts, horizon)
        below = ahead._jdf.queryExecution().optimizedPlan().toString().split("Generate", 1)[1]
        assert any("Filter" in line and ">=" in line for line in below.splitlines())
        expected = set()
        for store in range(1, 28):
            newest = AS_OF - timedelta(days=1 if store % 9 == 0 else 0)
            for run in (newest, newest - timedelta(days=2)):
                for n in range(60):
                    day = start + timedelta(days=n + 364)
                    if first <= (day - run).days <= last:
                        expected.add((store, day, run))
        assert {(r[LOC], r[DAY], r[GEN]) for r in ahead.collect()} == expected


def test_last_years_facts_of_unforecast_dates_are_not_joined(spark):
    days = [date(2001, 7, 17), date(2001, 7, 18)]
    forecast = spark.createDataFrame(
        [(1, days[0], 4, "00:00:00", 2.0, AS_OF)],
        f"{LOC} int, {DAY} date, item_id int, interval_start_time string, forecast double, {GEN} date",
    )
    dates = spark.createDataFrame(
        [(1, d, d - timedelta(days=364)) for d in days] + [(2, days[0], days[0] - timedelta(days=364))],
        f"{LOC} int, {DAY} date, ly_date date",
    )
    facts = spark.createDataFrame(
        [(s, d - timedelta(days=364), 4, datetime(2000, 7, 1, 0, 15), 3.0) for s in (1, 2) for d in days],
        f"{LOC} int, {DAY} date, product int, timequarter timestamp_ntz, sum_daily_quantity double",
    )
    items = delivery.doc_items(forecast, facts, dates)
    # Without the cut of the facts' dates the plan has six.
    assert items._jdf.queryExecution().optimizedPlan().toString().count("Join LeftSemi") > 6
    got = {(r[LOC], r["intervalstart"][-8:], str(r["transactioncount"]), str(r["lastyearcount"])) for r in items.collect()}
    assert len(got) == 96 and {r[0] for r in got} == {1}
    assert {r for r in got if r[2:] != ("0.00", "0.00")} == {(1, "00:00:00", "2.00", "0.00"), (1, "00:15:00", "0.00", "3.00")}


def _lines(spark, tmp_path, rows):
    """A folder with these lines: order, part, supplier, line number, quantity, price, flag, day."""
    line = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"
    )
    spark.createDataFrame(rows, line).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 0), (2, 1)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    return Views(spark, str(tmp_path))


def test_deferred_cells_are_those_of_the_deferred_lines_alone(spark, tmp_path):
    day = datetime(2000, 7, 18)
    v = _lines(
        spark, tmp_path,
        [(4, 1, 1, 2, 2.0, 10.0, "R", day), (4, 1, 1, 2, 2.0, 10.0, "R", day), (4, 1, 1, 2, 3.0, 5.0, "N", day),
         (100, 1, 1, 2, 1.0, 7.0, None, day), (5, 1, 1, 2, None, None, "R", day), (6, 1, 2, 2, 1.0, 1.0, "A", day),
         (None, 1, 1, 2, 1.0, 2.0, "R", None)],
    )
    for all_lines, deferred, per in ((v.sales_15min, v.deferred_sales_15min, v._sales), (v.items_15min, v.deferred_items_15min, v._items)):
        for got, lines in ((all_lines, v.lines), (deferred, v.lines.where("flag = 'R'"))):
            expected = per(lines, "timequarter")
            assert got.schema == expected.schema
            assert sorted(got.collect(), key=repr) == sorted(expected.collect(), key=repr)
    assert v.deferred_sales_15min.count() == 3
    # Both come out of one table.
    assert v.deferred_sales_15min.inputFiles() == v.sales_15min.inputFiles()


def test_forecasts_read_versions_of_their_own_quarter_hours(spark, tmp_path):
    old = [(-4 - n, 1, 1 + n % 2, n % 2, 1.0 + n, 1.0, "N", datetime(2000, 7, 1) + timedelta(days=n // 2)) for n in range(80)]
    twice = [(96 * n, 1, 1, k, 5.0 + k, 2.0, "N", datetime(2000, 7, 20) + timedelta(days=n)) for n in range(5) for k in (0, 1)]
    v = _lines(spark, tmp_path, [*old, *twice, (None, 1, 1, 1, 1.0, 1.0, "N", datetime(2000, 7, 20)), (None, 1, 1, 1, 1.0, 1.0, "N", datetime(2000, 1, 1))])
    for horizon in HORIZONS:
        for facts, latest in ((v.sales_15min, v._latest_sales), (v.items_15min, v._latest_items)):
            cut = v._ahead(latest(v._near(facts, horizon)), horizon)
            whole = v._ahead(latest(facts), horizon)
            assert sorted(cut.collect(), key=repr) == sorted(whole.select(cut.columns).collect(), key=repr)
            assert cut.count() > 0
            below = cut._jdf.queryExecution().optimizedPlan().toString().split("Window", 1)[1]
            assert any("Filter" in line and "timequarter" in line and ">=" in line for line in below.splitlines())


def test_partitions_follow_the_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("catalog.views.LINES_PER_TASK", 3)
    v = _lines(spark, tmp_path, [(n, 1, 1, 2, 1.0, 1.0, "N", datetime(2000, 7, 18)) for n in range(100)])
    assert v._partitions == 34
    assert _exchanges(v._sales(v.lines, "timequarter", parts=v._partitions))[-1].count(", 34)") == 1


def test_one_limit_derives_the_tables_of_its_metric_only(spark, monkeypatch):
    from catalog import forecasts

    class Only(Views):
        sales_daily = items_daily = property(lambda self: 1 / 0)
        ingredients_15min = calendar_daily = None

    monkeypatch.setattr(forecasts.limits, "ingredient_demand", lambda *given: given)
    assert forecasts.demand(Only(spark, "unused"), "ingredient")[0] is None


def _odd_lines(spark, tmp_path):
    """Lines with null and negative keys, repeated rows, a store of few dates and one that lags."""
    day = datetime(2000, 6, 1)
    rows = [(n * 7 - 40, 1 + n % 3, 1, n % 2, 1.0 + n, 1.0, "R" if n % 4 else "N", day + timedelta(days=n // 3)) for n in range(300)]
    rows += [(n, 1, 2, 1, 2.0, 1.0, "N", datetime(1999, 1, 1) + timedelta(days=n)) for n in range(8)]
    rows += [(n, 1, 3, 1, 2.0, 1.0, "N", day + timedelta(days=n)) for n in range(5)]
    rows += [(None, 1, 1, 1, 3.0, 4.0, "R", datetime(2001, 10, 1)), (None, 1, 1, 1, 5.0, 6.0, "N", datetime(2000, 7, 20)),
             (9, 1, 1, 1, 3.0, 4.0, "R", None), (9, None, 1, 1, 3.0, 4.0, "R", datetime(2001, 10, 2)), rows[0], rows[0]]
    # Part 3 is in no recipe: the newest dates of store 1 have no ingredients.
    rows += [(n, 3, 1, 1, 1.0, 1.0, "N", datetime(2001, 10, 5) + timedelta(days=n)) for n in range(6)]
    v = _lines(spark, tmp_path, rows)
    spark.createDataFrame([(1, 0), (2, 1), (3, None)], "s_suppkey long, s_nationkey int").write.mode("overwrite").parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(1, 5, 900.0), (2, 6, 800.0), (2, 6, 800.0)], "p_partkey long, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    return v


def _rows(df, *drop):
    return sorted(map(repr, df.drop(*drop).collect()))


def test_parts_hold_whole_cells_of_their_dates(spark, tmp_path):
    v = _odd_lines(spark, tmp_path)
    for name in ("sales_15min", "items_15min", "ingredients_15min", "deferred_sales_15min", "deferred_items_15min", "sales_daily"):
        near, whole = getattr(v.near, name), getattr(v, name)
        cut = F.col(DAY).between(F.lit(AS_OF + timedelta(days=13 - 365)), F.lit(AS_OF + timedelta(days=29 - 363)))
        assert _rows(near.where(cut)) == _rows(whole.where(cut)) and near.where(cut).count() > 0
        assert near.count() < whole.count()
    for horizon in HORIZONS:
        for got, facts, latest in (
            (v.forecast_15min(horizon), v.sales_15min, v._latest_sales),
            (v.forecast_items_15min(horizon), v.items_15min, v._latest_items),
        ):
            whole = v._ahead(latest(v._near(facts, horizon)), horizon)
            assert got.count() == whole.count() > 0
            measure = "sales_sub_total" if "sales_sub_total" in whole.columns else "sum_daily_quantity"
            whole = whole.select(LOC, DAY, F.col(measure).cast("double").alias("forecast"), GEN)
            assert _rows(got.select(LOC, DAY, "forecast", GEN)) == _rows(whole)


def test_newest_dates_of_a_recent_part_are_those_of_all_lines(spark, tmp_path):
    v = _odd_lines(spark, tmp_path)
    for n in (4, 7):
        recent = v.recent(n)
        for name in ("sales_daily", "items_daily", "ingredients_15min"):
            newest = []
            for rows in (getattr(v, name).collect(), getattr(recent, name).collect()):
                dates = {s: sorted({r[DAY] or date.min for r in rows if r[LOC] == s})[-n:] for s in (1, 2, None)}
                newest.append(sorted(repr(r) for r in rows if (r[DAY] or date.min) in dates[r[LOC]]))
            assert newest[0] == newest[1] != []
        assert recent.lines.count() < v.lines.count()


def test_document_checks_store_no_facts_of_all_history(spark, tmp_path, monkeypatch):
    from catalog import checks

    built = []
    kept = Views.stored

    def noted(self, name, *given):
        built.append(self._prefix + name)
        return kept(self, name, *given)

    monkeypatch.setattr(Views, "stored", noted)
    _odd_lines(spark, tmp_path)
    spark.createDataFrame([(0,), (1,)], "n_nationkey int").write.parquet(f"{tmp_path}/nation.parquet")
    assert checks.DocumentChecks(Views(spark, str(tmp_path))).alerts.columns
    assert "near_item_cells" in built and "recent_56_sales_cells" in built
    assert not {"sales_cells", "item_cells", "ingredients_15min", "sales_daily"} & set(built)


def test_long_checks_and_delivered_documents_store_no_facts_of_all_history(spark, tmp_path, monkeypatch):
    from catalog import checks, forecasts

    built = []
    kept = Views.stored

    def noted(self, name, *given):
        built.append(self._prefix + name)
        return kept(self, name, *given)

    monkeypatch.setattr(Views, "stored", noted)
    _odd_lines(spark, tmp_path)
    spark.createDataFrame([(0,), (1,)], "n_nationkey int").write.parquet(f"{tmp_path}/nation.parquet")
    whole = {"sales_cells", "item_cells", "ingredients_15min", "sales_daily", "latest_sales_daily"}
    assert forecasts.Documents(Views(spark, str(tmp_path)), stored=True).build().count() > 0
    assert "near_item_cells" in built and not whole & set(built)
    assert not [name for name in built if name.startswith("recent_")]  # documents need no limits
    assert checks.DocumentChecks(Views(spark, str(tmp_path)), "long").alerts.columns
    assert "doc_items_long" in built and "recent_56_sales_cells" in built and not whole & set(built)

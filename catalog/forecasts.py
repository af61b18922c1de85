"""Forecast plans (K rows) beside their SQL."""

from __future__ import annotations

from datetime import date

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import AS_OF, DAY, GEN, LOC, STAPLE_INGREDIENT, STAPLE_ITEM, STAPLES, Views
from catalog.views_sql import AS_OF as TODAY
from catalog.views_sql import VIEWS_SQL as V
from catalog.views_sql import closed_holiday, dec2, last_year
from tillcast.operators import predicates as P
from tillcast.plans import (
    baseline,
    breakdown,
    delivery,
    imputation,
    limits,
    model_input,
    naive,
    preparation,
    scoring,
)

PAST_ITEMS = ["sum_daily_quantity"]
PAST_METRICS = ["sales_sub_total", "trans_count"]


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})


# -- baseline ------------------------------------------------------------------

V["control"] = f"""
  SELECT s.location_num, d prediction_date,
    coalesce(CAST(naming_conv[1:1] AS INTEGER), 5) lookup_weeks,
    coalesce(CAST(naming_conv[7:8] AS INTEGER) / 1e2, 0e0) smoothing_fact,
    d > {TODAY} + 19 is_long
  FROM stores s LEFT JOIN settings c ON s.location_num = c.location_num,
    (SELECT {TODAY} + CAST(i AS INTEGER) d FROM range(16, 25) r(i) WHERE i <> 20)"""
V["operable"] = f"""
  SELECT location_num, prediction_date FROM control
  WHERE isodow(prediction_date) <> 7 AND NOT {closed_holiday("prediction_date")}
    AND NOT (isodow(prediction_date) = 6
      AND location_num IN (SELECT location_num FROM saturday_off))"""
V["baseline_dates"] = f"""
  SELECT location_num, prediction_date, business_date, lookup_weeks,
    count(*) OVER (PARTITION BY location_num, prediction_date) forecast_avg_dr,
    {TODAY} generation_date
  FROM (
    SELECT * FROM (
      SELECT w.location_num, w.prediction_date, c.business_date, w.lookup_weeks, c.sales_sub_total
      FROM (SELECT k.location_num, k.prediction_date,
          lookup_weeks - CASE WHEN is_long THEN 1 ELSE 0 END lookup_weeks
        FROM control k JOIN operable USING (location_num, prediction_date)) w
      JOIN (
        SELECT location_num, business_date, sales_sub_total FROM sales_daily
        WHERE business_date < {TODAY}
          AND (location_num, business_date) IN (SELECT (location_num, business_date)
            FROM items_daily WHERE business_date < {TODAY} AND product < 10)
        QUALIFY generation_date = max(generation_date)
          OVER (PARTITION BY location_num, business_date)) c
      ON c.location_num = w.location_num
        AND isodow(c.business_date) = isodow(w.prediction_date)
      QUALIFY rank() OVER (PARTITION BY w.location_num, w.prediction_date
        ORDER BY c.business_date DESC) < w.lookup_weeks)
    QUALIFY sales_sub_total <> min(sales_sub_total)
        OVER (PARTITION BY location_num, prediction_date)
      AND sales_sub_total <> max(sales_sub_total)
        OVER (PARTITION BY location_num, prediction_date))"""
V["baseline_trend"] = f"""
  SELECT c.location_num, c.prediction_date, c.smoothing_fact,
    CASE WHEN c.smoothing_fact = 0 OR ly_avg = 0 THEN 0e0 ELSE (ly - ly_avg) / ly_avg END trend,
    {TODAY} generation_date
  FROM (SELECT k.location_num, k.prediction_date, k.smoothing_fact,
      coalesce(CAST(sum(h.sales_sub_total) AS DOUBLE), 0e0) / k.lookup_weeks ly_avg
    FROM control k LEFT JOIN latest_sales_daily h ON h.location_num = k.location_num
      AND h.business_date < k.prediction_date - 364
      AND h.business_date >= k.prediction_date - 364 - 7 * k.lookup_weeks
      AND isodow(h.business_date) = isodow(k.prediction_date)
    GROUP BY k.location_num, k.prediction_date, k.smoothing_fact, k.lookup_weeks) c
  LEFT JOIN (SELECT location_num, business_date, CAST(sales_sub_total AS DOUBLE) s
    FROM latest_sales_daily) l
    ON l.location_num = c.location_num AND l.business_date = c.prediction_date - 364,
  LATERAL (SELECT coalesce(l.s, 0e0) ly)"""


def _baseline_sql(table: str, by: str, measures: list[str], base: str) -> str:
    by_comma, by_join = (f"{by}, ", f"AND f.{by} = g.{by}") if by else ("", "")
    sums = ", ".join(
        f"CAST(sum(q.{m}) AS DOUBLE) / forecast_avg_dr * 1e0 AS a_{m}" for m in measures
    )
    outs = ", ".join(
        f"coalesce(a_{m} + a_{m} * trend * smoothing_fact, 0e0) AS forecast_{m}" for m in measures
    )
    return f"""
  SELECT g.location_num, {"g." + by + ", " if by else ""}g.business_date, g."interval", {outs},
    {TODAY} generation_date
  FROM (SELECT b.*, c.d business_date, t."interval" FROM ({base}) b,
      (SELECT DISTINCT prediction_date d FROM control) c, time_grid t) g
  LEFT JOIN (SELECT q.location_num, d.prediction_date,
      strftime(q.timequarter, '%H:%M:%S') AS "interval", {by_comma}forecast_avg_dr, {sums}
    FROM {table} q JOIN baseline_dates d
      ON d.location_num = q.location_num AND d.business_date = q.business_date
    GROUP BY q.location_num, {by_comma}d.prediction_date, 3, forecast_avg_dr) f
    ON f.location_num = g.location_num AND f.prediction_date = g.business_date
      AND f."interval" = g."interval" {by_join}
  LEFT JOIN baseline_trend r
    ON r.location_num = f.location_num AND r.prediction_date = f.prediction_date"""


V["baseline_metrics"] = _baseline_sql(
    "latest_sales_15min", "", PAST_METRICS, "SELECT location_num FROM stores"
)
V["baseline_items"] = _baseline_sql(
    "latest_items_15min",
    "product",
    PAST_ITEMS,
    "SELECT DISTINCT location_num, product FROM items_15min WHERE (location_num, business_date) "
    "IN (SELECT (location_num, business_date) FROM baseline_dates)",
)


def control(v: Views) -> DataFrame:
    """Store, prediction date, lookup weeks and smoothing, both horizons."""
    return baseline.control_table(v.stores, v.settings, AS_OF, reduce_long=False)


def k01(v: Views) -> DataFrame:
    return baseline.baseline_dates(
        v.sales_daily, v.items_daily, v.settings, v.stores, v.saturday_off, AS_OF, STAPLES
    )


def k02(v: Views) -> DataFrame:
    return baseline.baseline_trend(v.sales_daily, v.settings, v.stores, AS_OF)


def control_tables(v: Views) -> tuple[DataFrame, DataFrame]:
    """History dates and trend as the stored tables that both forecasts read."""
    return (
        v.stored("baseline_dates", lambda: k01(v), LOC, "prediction_date"),
        v.stored("baseline_trend", lambda: k02(v), LOC, "prediction_date"),
    )


def k03(v: Views) -> DataFrame:
    return baseline.baseline_forecast(
        v.sales_15min, *control_tables(v), v.stores, PAST_METRICS, AS_OF
    )


def k04(v: Views) -> DataFrame:
    return baseline.baseline_forecast(
        v.items_15min, *control_tables(v), v.stores, PAST_ITEMS, AS_OF, by="product"
    )


@query("k01_baseline_dates", "SELECT * FROM baseline_dates")
def _(v):
    return k01(v)


@query(
    "k02_baseline_trend",
    "SELECT location_num, prediction_date, smoothing_fact, round(trend, 6) trend, "
    "generation_date FROM baseline_trend",
)
def _(v):
    return rounded(k02(v), "trend")


@query(
    "k03_baseline_metrics",
    """SELECT * REPLACE (round(forecast_sales_sub_total, 4) AS forecast_sales_sub_total,
      round(forecast_trans_count, 4) AS forecast_trans_count) FROM baseline_metrics""",
)
def _(v):
    return rounded(k03(v), "forecast_sales_sub_total", "forecast_trans_count", digits=4)


@query(
    "k04_baseline_items",
    "SELECT * REPLACE (round(forecast_sum_daily_quantity, 4) AS forecast_sum_daily_quantity) "
    "FROM baseline_items",
)
def _(v):
    return rounded(k04(v), "forecast_sum_daily_quantity", digits=4)


@query(
    "k04_products_per_store",
    "SELECT location_num, count(DISTINCT product) products FROM baseline_items GROUP BY 1",
)
def _(v):
    from tillcast.operators.aggregates import products_per_store

    return products_per_store(k04(v))


V["baseline_ingredients"] = f"""
  SELECT i.location_num, r.ingredient_id, business_date, "interval", unit_of_measure,
    CAST(round(sum(CAST(CAST(forecast_sum_daily_quantity * coalesce(y.ycf, 1e0)
      * ingredient_quantity AS VARCHAR) AS DECIMAL(28,9))), 2) AS DOUBLE) sumingredient, {TODAY} generation_date
  FROM baseline_items i JOIN recipe r ON r.pin = i.product
  LEFT JOIN (SELECT location_num, ingredient_id, avg(ycf) ycf FROM ycf GROUP BY 1, 2) y
    ON y.location_num = i.location_num AND y.ingredient_id = r.ingredient_id
  GROUP BY ALL"""


def k05(v: Views) -> DataFrame:
    items = v.stored("baseline_items", lambda: k04(v), LOC, DAY)
    return baseline.baseline_ingredients(items, v.recipe, v.ycf, AS_OF)


@query("k05_baseline_ingredients", "SELECT * FROM baseline_ingredients")
def _(v):
    return k05(v)


# -- breakdown -------------------------------------------------------------------

_MASK = """(isodow({d}) = 7 OR (isodow({d}) = 6
      AND {l} IN (SELECT location_num FROM saturday_off)))"""


def _latest(table: str, keys: str = "location_num") -> str:
    return (
        f"(SELECT * FROM {table} QUALIFY generation_date = "
        f"max(generation_date) OVER (PARTITION BY {keys}))"
    )


def _k06_sql(horizon: str, snapshot: bool) -> str:
    ratio_1 = _latest("sales_ratios") if snapshot else "sales_ratios"
    ratio_2 = _latest("trans_ratios") if snapshot else "trans_ratios"
    closed = _MASK.format(d="r.business_date", l="r.location_num")
    return f"""SELECT DISTINCT r.business_date, r.time timequarter,
      {dec2(f"CASE WHEN {closed} THEN 0e0 ELSE s.forecast * r.ratio END")} min15_forecast,
      {dec2(f"CASE WHEN {closed} THEN 0e0 ELSE t.forecast * q.ratio END")} min15_forecast_trans,
      {TODAY} generation_date, r.location_num
    FROM {_latest("forecast_sales_" + horizon)} s
    JOIN {_latest("forecast_trans_" + horizon)} t
      ON t.location_num = s.location_num AND t.business_date = s.business_date
    JOIN {ratio_1} r ON r.location_num = s.location_num AND r.business_date = s.business_date
    JOIN {ratio_2} q ON q.location_num = r.location_num AND q.business_date = r.business_date
      AND q.time = r.time"""


def _k06(v: Views, horizon: str) -> DataFrame:
    return breakdown.breakdown_metrics(
        v.forecast_sales(horizon),
        v.forecast_trans(horizon),
        v.metric_ratios("sales_sub_total"),
        v.metric_ratios("trans_count"),
        v.saturday_off,
        AS_OF,
    )


query("k06_breakdown_metrics", _k06_sql("short", True))(lambda v: _k06(v, "short"))
query("k06_breakdown_metrics_long", _k06_sql("long", True))(lambda v: _k06(v, "long"))


@query("k06_breakdown_metrics_redundancy", _k06_sql("redundancy", False))
def _(v):
    return breakdown.breakdown_metrics(
        v.forecast_sales("redundancy"),
        v.forecast_trans("redundancy"),
        v.metric_ratios("sales_sub_total"),
        v.metric_ratios("trans_count"),
        v.saturday_off,
        AS_OF,
        snapshot_ratios=False,
    )


def _k07_sql(horizon: str) -> str:
    closed = _MASK.format(d="f.business_date", l="f.location_num")
    newest = _latest("forecast_items_" + horizon, "location_num, business_date")
    pair = (
        "r.location_num = f.location_num AND r.business_date = f.business_date "
        "AND r.product = f.item_id"
    )
    return f"""SELECT f.business_date, f.item_id product, r.time timequarter,
      {dec2(f"CASE WHEN {closed} THEN 0e0 ELSE f.forecast * r.ratio END")} min15_forecast,
      {TODAY} generation_date, f.location_num
    FROM {newest} f JOIN item_ratios r ON {pair}
    UNION
    SELECT f.business_date, f.item_id, g."interval",
      CASE WHEN {closed} OR g."interval" NOT BETWEEN '06:00:00' AND '22:00:00' THEN 0
        ELSE {dec2("f.forecast / 65e0")} END,
      {TODAY}, f.location_num
    FROM {newest} f, time_grid g
    WHERE NOT EXISTS (SELECT 1 FROM item_ratios r WHERE {pair})"""


for _horizon in ("short", "long", "redundancy"):

    def _spread(v: Views, horizon: str = _horizon) -> DataFrame:
        return breakdown.breakdown_items(
            v.forecast_items(horizon), v.item_ratios(), v.saturday_off, AS_OF
        )

    query("k07_breakdown_items" + ("" if _horizon == "short" else f"_{_horizon}"), _k07_sql(_horizon))(_spread)


def _k08_sql(horizon: str, redundancy: bool) -> str:
    newest = _latest("forecast_items_15min_" + horizon, "location_num, business_date")
    distinct = "" if redundancy else "DISTINCT"
    recipe = (
        "recipe_history"
        if redundancy
        else "(SELECT DISTINCT pin, ingredient_quantity, ingredient_id, unit_of_measure FROM recipe)"
    )
    ycf = _latest("ycf")
    factors = (
        f"SELECT DISTINCT location_num, ingredient_id, ycf FROM {ycf} y"
        if redundancy
        else f"SELECT location_num, ingredient_id, avg(ycf) ycf FROM {ycf} y GROUP BY 1, 2"
    )
    used = dec2("i.forecast * r.ingredient_quantity * coalesce(y.ycf, 1e0)")
    return f"""SELECT business_date, i.location_num, r.ingredient_id, unit_of_measure,
      interval_start_time, CAST(sum({used}) AS DECIMAL(18,2)) sumingredient,
      {TODAY} generation_date
    FROM (SELECT {distinct} forecast, business_date, location_num, item_id, interval_start_time
      FROM {newest} n) i
    JOIN {recipe} r ON r.pin = i.item_id
    LEFT JOIN ({factors}) y
      ON y.location_num = i.location_num AND y.ingredient_id = r.ingredient_id
    GROUP BY ALL"""


def _k08(v: Views, horizon: str, redundancy: bool) -> DataFrame:
    out = breakdown.breakdown_ingredients(
        v.forecast_items_15min(horizon),
        v.recipe_history,
        v.ycf,
        AS_OF,
        redundancy=redundancy,
    )
    return out.withColumn("sumingredient", F.col("sumingredient").cast("decimal(18,2)"))


@query("k08_breakdown_ingredients", _k08_sql("short", False))
def _(v):
    return _k08(v, "short", False)


@query("k08_breakdown_ingredients_long", _k08_sql("long", False))
def _(v):
    return _k08(v, "long", False)


@query("k08_breakdown_ingredients_redundancy", _k08_sql("redundancy", True))
def _(v):
    return _k08(v, "redundancy", True)


@query(
    "k08_breakdown_dates",
    """SELECT DISTINCT location_num, business_date FROM (
      SELECT * FROM forecast_items_short WHERE item_id = 1
      QUALIFY generation_date = max(generation_date) OVER (PARTITION BY location_num))""",
)
def _(v):
    return breakdown.breakdown_dates(v.forecast_items("short"), STAPLE_ITEM)


# -- preparation -------------------------------------------------------------------

_BOUNDS = """(SELECT location_num, max(business_date) AS a FROM {final} GROUP BY 1) lo
      JOIN (SELECT location_num, max(business_date) AS b FROM {initial} GROUP BY 1) hi
        USING (location_num)"""
_FEATURE_SQL = ", ".join(f"c.{f}" for f in preparation.FEATURES if f != "sunday")


@query(
    "k09_prep_metrics_15min",
    f"""SELECT location_num, c.business_date, c.timequarter,
      coalesce(i.sales_sub_total, 0) sales_sub_total, coalesce(i.trans_count, 0) trans_count,
      {TODAY} generation_date
    FROM {_BOUNDS.format(final="prepared_sales_15min", initial="sales_15min")}
    JOIN calendar_15min c ON c.business_date > a AND c.business_date <= b
    LEFT JOIN sales_15min i USING (location_num, business_date, timequarter)""",
)
def _(v):
    return preparation.prep_metrics_15min(
        v.calendar_15min, v.prepared(v.latest_sales_15min), v.sales_15min, AS_OF
    )


@query(
    "k10_prep_metrics_daily",
    f"""SELECT location_num, c.business_date, {_FEATURE_SQL},
      CASE WHEN location_num IN (SELECT location_num FROM saturday_off) AND c.dayofweek IN (6, 7)
        THEN 1 ELSE c.sunday END weekends,
      coalesce(i.sales_sub_total, 0) sales_sub_total, coalesce(i.trans_count, 0) trans_count,
      {TODAY} generation_date
    FROM {_BOUNDS.format(final="prepared_sales_daily", initial="sales_daily")}
    JOIN calendar_daily c ON c.business_date > a AND c.business_date <= b
    LEFT JOIN sales_daily i USING (location_num, business_date)""",
)
def _(v):
    return preparation.prep_metrics_daily(
        v.calendar_daily,
        v.prepared(v.latest_sales_daily),
        v.sales_daily,
        v.saturday_off,
        AS_OF,
    )


_ITEM_BOUNDS = _BOUNDS.format(
    final="prepared_items_daily", initial=_latest("items_daily") + " n"
)
_PRODUCTS = "(SELECT DISTINCT location_num, product FROM items_daily) p"


@query(
    "k11_prep_items_15min",
    f"""SELECT location_num, product, c.business_date, c.timequarter,
      coalesce(i.sum_daily_quantity, 0) sum_daily_quantity, {TODAY} generation_date
    FROM {_ITEM_BOUNDS} JOIN {_PRODUCTS} USING (location_num)
    JOIN calendar_15min c ON c.business_date > a AND c.business_date <= b
    LEFT JOIN items_15min i USING (location_num, product, business_date, timequarter)""",
)
def _(v):
    return preparation.prep_items_15min(
        v.calendar_15min,
        v.prepared(v.latest_items_daily),
        v.items_daily,
        v.items_15min,
        AS_OF,
    )


@query(
    "k12_prep_items_daily",
    f"""SELECT location_num, product, c.business_date, {_FEATURE_SQL}, c.sunday,
      coalesce(i.sum_daily_quantity, 0) sum_daily_quantity, {TODAY} generation_date
    FROM {_ITEM_BOUNDS} JOIN {_PRODUCTS} USING (location_num)
    JOIN calendar_daily c ON c.business_date > a AND c.business_date <= b
    LEFT JOIN items_daily i USING (location_num, product, business_date)""",
)
def _(v):
    return preparation.prep_items_daily(
        v.calendar_daily, v.prepared(v.latest_items_daily), v.items_daily, AS_OF
    )


FIRST_INGREDIENT_DATE = date(2001, 10, 20)


@query(
    "k13_prep_ingredients",
    f"""SELECT i.business_date, i.location_num, r.ingredient_id, r.unit_of_measure, i.timequarter,
      round(sum(CAST(sum_daily_quantity AS DOUBLE) * r.ingredient_quantity), 4)
        ingredient_quantity,
      strftime(i.timequarter, '%H:%M:%S') AS "quarters", {TODAY} generation_date
    FROM items_15min i JOIN recipe r ON r.pin = i.product
    LEFT JOIN (SELECT location_num, max(business_date) AS a FROM ingredients_15min
      WHERE location_num % 2 = 0 AND business_date <= DATE '2001-10-28' GROUP BY 1) d
      ON d.location_num = i.location_num
    WHERE i.business_date > coalesce(a, DATE '2001-10-20') GROUP BY ALL""",
)
def _(v):
    known = v.prepared(v.ingredients_15min).where(F.col(LOC) % 2 == 0)
    out = preparation.prep_ingredients(
        v.items_15min, known, v.recipe, AS_OF, FIRST_INGREDIENT_DATE
    )
    return rounded(out, "ingredient_quantity", digits=4)


# -- model input -------------------------------------------------------------------

V["last_good"] = f"""
  SELECT location_num, coalesce(good, newest) max_date
  FROM (SELECT location_num, max(business_date) newest FROM past_sales_daily GROUP BY 1)
  LEFT JOIN (SELECT m.location_num, max(m.business_date_max) good
    FROM metric_checks m JOIN item_checks i ON i.location_num = m.location_num
      AND i.generation_date = m.generation_date
    WHERE m.dailyqc = 1 AND i.dailyqc = 1 AND m.generation_date > {TODAY} - 61
    GROUP BY 1) USING (location_num)"""


def _input_sql(keys: str, series: str, facts: str, measures: list[str]) -> str:
    feats = ", ".join(f"c.{f}" for f in preparation.FEATURES if f != "sunday")
    seen = ", ".join(f"coalesce(f.{m}, 0) {m}" for m in measures)
    none = ", ".join("CAST(0 AS DECIMAL(18,2))" for _ in measures)
    return f"""
  SELECT *, (SELECT max(generation_date) FROM {{checks}}) dataprep_generation_date FROM (
    SELECT {keys}, c.business_date, {feats}, c.sunday, {seen}
    FROM ({series}) s JOIN last_good g USING (location_num)
    JOIN calendar_daily c ON c.business_date > max_date - 56 AND c.business_date <= {TODAY} - 2
    LEFT JOIN (SELECT f.* FROM {facts} f JOIN last_good g ON g.location_num = f.location_num
      AND f.business_date <= g.max_date) f USING ({keys}, business_date)
    UNION
    SELECT {keys}, c.business_date, {feats},
      CASE WHEN location_num IN (SELECT location_num FROM saturday_off) AND c.dayofweek IN (6, 7)
        THEN 1 ELSE c.sunday END, {none}
    FROM ({series}) s JOIN calendar_daily c
      ON c.business_date > {TODAY} - 2 AND c.business_date <= {TODAY} + 30)"""


V["input_metrics"] = _input_sql(
    "location_num",
    "SELECT DISTINCT location_num FROM past_sales_daily",
    "past_sales_daily",
    PAST_METRICS,
).format(checks="metric_checks")
V["input_items"] = _input_sql(
    "location_num, product",
    "SELECT DISTINCT location_num, product FROM past_items_daily "
    "SEMI JOIN combinations USING (location_num, product)",
    "past_items_daily",
    PAST_ITEMS,
).format(checks="item_checks")


def last_good(v: Views) -> DataFrame:
    return model_input.last_good_date(
        v.metric_checks, v.item_checks, v.past(v.latest_sales_daily), AS_OF
    )


def input_metrics(v: Views) -> DataFrame:
    facts = v.past(v.latest_sales_daily)
    return model_input.model_input(
        facts,
        facts.select(LOC),
        v.calendar_daily,
        v.stored("last_good", lambda: last_good(v), LOC),
        v.saturday_off,
        PAST_METRICS,
        AS_OF,
        v.metric_checks,
    )


def input_items(v: Views) -> DataFrame:
    """The stored input of the scoring chain."""
    return v.stored("input_items", lambda: _input_items(v), LOC, "product", DAY)


def _input_items(v: Views) -> DataFrame:
    facts = v.past(v.latest_items_daily)
    return model_input.model_input(
        facts,
        model_input.modelled_pairs(facts, v.combinations),
        v.calendar_daily,
        v.stored("last_good", lambda: last_good(v), LOC),
        v.saturday_off,
        PAST_ITEMS,
        AS_OF,
        v.item_checks,
    )


@query("k14_last_good_date", "SELECT * FROM last_good")
def _(v):
    return last_good(v)


@query("k15_model_input_metrics", "SELECT * FROM input_metrics")
def _(v):
    return input_metrics(v)


@query("k16_model_input_items", "SELECT * FROM input_items")
def _(v):
    return _input_items(v)


# -- naive -------------------------------------------------------------------------

V["unmodelled"] = """
  SELECT location_num, product, max(business_date) max_business_date FROM items_daily
  WHERE business_date < DATE '2001-07-01' ANTI_ GROUP BY 1, 2""".replace(
    "ANTI_",
    "AND (location_num, product) NOT IN (SELECT (location_num, product) FROM combinations)",
)


def unmodelled(v: Views) -> DataFrame:
    seen = v.items_daily.where(F.col(DAY) < F.lit(AS_OF))
    return naive.unmodelled_pairs(seen, v.combinations)


_HORIZON_CASE = f"""CASE WHEN business_date - {TODAY} BETWEEN 16 AND 19 THEN 'short'
      WHEN business_date - {TODAY} BETWEEN 21 AND 24 THEN 'long' ELSE 'redundancy' END"""


V["naive_series"] = f"""
  SELECT location_num, product, 0 n, list(coalesce(q, 0e0) ORDER BY d) series
  FROM (SELECT DISTINCT location_num, product FROM unmodelled JOIN past_items_daily
      USING (location_num, product)
    WHERE max_business_date >= {TODAY} - 30 AND business_date BETWEEN {TODAY} - 31 AND {TODAY} - 2)
    CROSS JOIN (SELECT {TODAY} - 31 + CAST(i AS INTEGER) d FROM range(30) r(i))
  LEFT JOIN (SELECT location_num, product, business_date d,
      CAST(sum(sum_daily_quantity) AS DOUBLE) q FROM past_items_daily GROUP BY 1, 2, 3)
    USING (location_num, product, d)
  GROUP BY 1, 2
  UNION ALL
  SELECT location_num, product, n + 1, list_append(series, list_median(series[-30:]))
  FROM naive_series WHERE n < 34"""


@query(
    "k17_naive_forecast",
    f"""SELECT location_num, product, s.business_date, {_HORIZON_CASE} horizon,
      round(CASE WHEN s.business_date IN (SELECT business_date FROM calendar_daily
        WHERE holiday = 1 AND year(business_date) = 2001) THEN 0e0 ELSE forecast END, 6) forecast,
      {TODAY} generation_date
    FROM (SELECT location_num, product, {TODAY} - 2 + step business_date, series[30 + step] forecast
      FROM naive_series, (SELECT CAST(unnest(range(1, 35)) AS INTEGER) step) WHERE n = 34) s
    WHERE s.business_date - {TODAY} BETWEEN 16 AND 19 OR s.business_date - {TODAY} BETWEEN 21 AND 24
      OR s.business_date - {TODAY} BETWEEN 25 AND 29""",
)
def _(v):
    pairs = naive.active_pairs(unmodelled(v), AS_OF)
    holidays = P.holidays(v.calendar_daily, AS_OF)
    out = naive.naive_forecast(v.past(v.latest_items_daily), pairs, holidays, AS_OF)
    return rounded(out, "forecast")


@query(
    "k18_zero_forecast",
    f"""SELECT location_num, product, business_date, {_HORIZON_CASE} horizon, 0e0 forecast,
      {TODAY} generation_date
    FROM (SELECT location_num, product, {TODAY} + CAST(i AS INTEGER) business_date
      FROM unmodelled, range(16, 30) r(i)
      WHERE max_business_date < {TODAY} - 30 AND i <> 20)""",
)
def _(v):
    return naive.zero_forecast(naive.dormant_pairs(unmodelled(v), AS_OF), AS_OF)


# -- imputation ----------------------------------------------------------------------

_SERIES_ITEMS = [LOC, "product"]
V["heads"] = """
  SELECT location_num, product, business_date, dayofweek, holiday, sunday, federalholiday,
    CAST(sum_daily_quantity AS DOUBLE) x,
    row_number() OVER (PARTITION BY location_num, product ORDER BY business_date) <= 56 head,
    dayofweek <> 7 AND aroundchristmas = 0 AND onedaypriorchristmas_and_new_year = 0
      AND blackfridaycheck = 0 AND holiday = 0 AND aroundthanksgiving = 0 AND federalholiday = 0
      AND NOT (dayofweek = 6 AND location_num IN (SELECT location_num FROM saturday_off)) regular
  FROM input_items"""
V["zero_imputed"] = """
  SELECT h.* REPLACE (coalesce(CASE WHEN h.head AND dayofweek <> 7 AND holiday = 0 AND x < 0.001
      THEN m ELSE x END, 0e0) AS x)
  FROM heads h LEFT JOIN (SELECT location_num, product, dayofweek, median(x) m FROM heads
    WHERE head AND dayofweek <> 7 AND holiday = 0 AND x > 0.001 GROUP BY 1, 2, 3)
    USING (location_num, product, dayofweek)"""
_BASE = "SELECT * FROM zero_imputed WHERE head AND regular"


def k19(v: Views) -> DataFrame:
    return imputation.impute_zeros(input_items(v), _SERIES_ITEMS, "sum_daily_quantity")


def _series_out(df: DataFrame) -> DataFrame:
    out = df.select(*_SERIES_ITEMS, DAY, F.col("sum_daily_quantity").alias("quantity"))
    return rounded(out, "quantity")


@query(
    "k19_impute_zeros",
    "SELECT location_num, product, business_date, round(x, 6) quantity FROM zero_imputed",
)
def _(v):
    return _series_out(k19(v))


@query(
    "k20_impute_outliers",
    f"""WITH b AS ({_BASE}), f AS (SELECT location_num, product,
        quantile_cont(x, 0.25) q1, quantile_cont(x, 0.75) q3, max(x) hi FROM b GROUP BY 1, 2),
      o AS (SELECT z.*, coalesce(z.head AND z.regular AND hi > 0.001
          AND (x < q1 - 1.5e0 * (q3 - q1) OR x > q3 + 1.5e0 * (q3 - q1)), false) bad
        FROM zero_imputed z LEFT JOIN f USING (location_num, product)),
      m AS (SELECT location_num, product, dayofweek, median(x) FILTER (NOT bad) m_in, median(x) m_all
        FROM o WHERE head AND regular GROUP BY 1, 2, 3)
    SELECT location_num, product, business_date,
      round(CASE WHEN bad THEN coalesce(m_in, m_all) ELSE x END, 6) quantity
    FROM o LEFT JOIN m USING (location_num, product, dayofweek)""",
)
def _(v):
    return _series_out(
        imputation.impute_outliers(k19(v), _SERIES_ITEMS, "sum_daily_quantity", v.saturday_off)
    )


V["weekday_fenced"] = f"""
  SELECT z.*, q1 - 1.5e0 * (q3 - q1) lower_limit, q3 + 1.5e0 * (q3 - q1) upper_limit,
    coalesce(z.head AND z.regular AND hi > 0.001
      AND (x < q1 - 1.5e0 * (q3 - q1) OR x > q3 + 1.5e0 * (q3 - q1)), false) bad
  FROM zero_imputed z
  LEFT JOIN (SELECT location_num, product, dayofweek, quantile_cont(x, 0.25) q1,
      quantile_cont(x, 0.75) q3 FROM ({_BASE}) GROUP BY 1, 2, 3)
    USING (location_num, product, dayofweek)
  LEFT JOIN (SELECT location_num, product, max(x) hi FROM ({_BASE}) GROUP BY 1, 2)
    USING (location_num, product)"""
V["weekday_medians"] = """
  SELECT location_num, product, dayofweek, median(x) FILTER (NOT bad) m
  FROM weekday_fenced WHERE head AND regular GROUP BY 1, 2, 3"""
V["weekday_imputed"] = """
  SELECT w.* REPLACE (CASE WHEN bad THEN m ELSE x END AS x)
  FROM weekday_fenced w LEFT JOIN weekday_medians USING (location_num, product, dayofweek)"""


def k21(v: Views) -> tuple[DataFrame, DataFrame]:
    return imputation.impute_outliers_by_weekday(
        k19(v), _SERIES_ITEMS, "sum_daily_quantity", v.saturday_off
    )


@query(
    "k21_impute_outliers_by_weekday",
    "SELECT location_num, product, business_date, round(x, 6) quantity FROM weekday_imputed",
)
def _(v):
    return _series_out(k21(v)[0])


@query(
    "k21_outlier_audit",
    """SELECT location_num, product, business_date, dayofweek, round(m, 6) median,
      round(lower_limit, 6) lower_limit, round(upper_limit, 6) upper_limit,
      round(x, 6) actuals, round(m, 6) imputed_actuals
    FROM weekday_fenced JOIN weekday_medians USING (location_num, product, dayofweek)
    WHERE bad""",
)
def _(v):
    names = ["median", "lower_limit", "upper_limit", "actuals", "imputed_actuals"]
    return rounded(k21(v)[1], *names)


V["backfilled"] = """
  SELECT s.location_num, s.product, s.business_date, s.dayofweek, s.holiday, s.federalholiday,
    CASE WHEN gap > 0 AND s.business_date <= target_end
        AND s.business_date > target_end - CAST(least(gap, 25) AS INTEGER)
      THEN c.x ELSE s.x END x
  FROM (SELECT *, count(*) OVER p - 88 gap, max(business_date) OVER p - 32 target_end
      FROM weekday_imputed WINDOW p AS (PARTITION BY location_num, product)) s
  LEFT JOIN (SELECT location_num, product, max(business_date) source_end
    FROM (SELECT *, max(business_date) OVER (PARTITION BY location_num, product) - 32 target_end
      FROM weekday_imputed) WHERE head AND isodow(business_date) = isodow(target_end) GROUP BY 1, 2) e
    USING (location_num, product)
  LEFT JOIN weekday_imputed c ON c.location_num = s.location_num AND c.product = s.product
    AND c.business_date = s.business_date - CAST(target_end - source_end AS INTEGER)"""


def repaired_items(v: Views) -> DataFrame:
    return imputation.repair_series(
        input_items(v), _SERIES_ITEMS, "sum_daily_quantity", v.saturday_off
    )


@query(
    "k22_backfill_gap",
    "SELECT location_num, product, business_date, round(x, 6) quantity FROM backfilled",
)
def _(v):
    return _series_out(repaired_items(v))


def mean_model(row: np.ndarray) -> float:
    """Stand-in model: a fixed linear read-out of the framed row."""
    weights = np.linspace(0.5, 1.5, len(row))
    return float(np.dot(row, weights) / weights.sum())


# Weights and scales of the stand-in model: 15 past rows of three columns, 10 of two.
_CELLS = 3 * scoring.LOOKBACK + 2 * scoring.HORIZON
_MEDIAN, _IQR = [10.0, 4.0, 0.0], [8.0, 3.0, 0.0]
V["score_input"] = f"""
  SELECT b.* FROM backfilled b JOIN locations USING (location_num)
  WHERE remodelreopendate > {TODAY} OR business_date >= remodelreopendate"""
V["gated"] = f"""
  SELECT location_num, product, count(*) rows_count, CASE WHEN count(*) < 57 THEN 'short'
    WHEN {TODAY} - (max(business_date) - 31) > 6 THEN 'stale' END gate
  FROM score_input GROUP BY 1, 2"""
V["scored_series"] = """
  SELECT location_num, product, count(*) n, list(x ORDER BY business_date) xs,
    list((dayofweek - 4e0) / 3e0 ORDER BY business_date) ds,
    list(CAST(federalholiday AS DOUBLE) ORDER BY business_date) fs,
    list(business_date ORDER BY business_date) dates, list(holiday = 1 ORDER BY business_date) off,
    list(dayofweek = 7 OR (dayofweek = 6 AND location_num IN (SELECT location_num FROM saturday_off))
      ORDER BY business_date) shut
  FROM score_input SEMI JOIN (SELECT * FROM gated WHERE gate IS NULL) USING (location_num, product)
  GROUP BY 1, 2"""
# The weight of cell c (from 0) is 0.5 + c / (cells - 1); t is the row (from 1) that is predicted.
_W = f"(0.5e0 + ({{c}}) / {_CELLS - 1}e0)"
V["scoring"] = f"""
  SELECT location_num, product, n, xs, ds, fs, shut, 0 step FROM scored_series
  UNION ALL
  SELECT location_num, product, n, list_concat(list_concat(xs[:t - 1], [
      CASE WHEN shut[t] THEN 0e0 ELSE 10 + 8 * (
        list_sum(list_transform(range(0, 15), lambda i:
          {_W.format(c="3 * i")} * (xs[t - 24 + i] - 10) / 8
          + {_W.format(c="3 * i + 1")} * ds[t - 24 + i] + {_W.format(c="3 * i + 2")} * fs[t - 24 + i]))
        + list_sum(list_transform(range(0, 10), lambda i:
          {_W.format(c="45 + 2 * i")} * ds[t - 9 + i] + {_W.format(c="46 + 2 * i")} * fs[t - 9 + i]))
        ) / {_CELLS}e0 END]), xs[t + 1:]), ds, fs, shut, step + 1
  FROM (SELECT *, n - 31 + step AS t FROM scoring) WHERE step < 32"""


def _scores(v: Views) -> tuple[DataFrame, DataFrame]:
    """Of a store that was rebuilt, only the days since it opened again count as history."""
    rows = repaired_items(v)
    opened = v.locations.select(LOC, F.col("remodelreopendate").alias("_opened"))
    since = (F.col("_opened") > F.lit(AS_OF)) | (F.col(DAY) >= F.col("_opened"))
    return scoring.score_gated(
        rows.join(opened, LOC).where(since).drop("_opened"),
        _SERIES_ITEMS,
        "sum_daily_quantity",
        ["dayofweek", "federalholiday"],
        mean_model,
        median=_MEDIAN,
        iqr=_IQR,
        sat_off=v.saturday_off,
        as_of=AS_OF,
    )


@query(
    "k23_score_recursive",
    """SELECT location_num, product, dates[n - 32 + k] business_date,
      round(CASE WHEN off[n - 32 + k] THEN 0e0 ELSE greatest(done.xs[n - 32 + k], 0e0) END, 6) forecast
    FROM (SELECT * FROM scoring WHERE step = 32) done
    JOIN (SELECT location_num, product, dates, off FROM scored_series) USING (location_num, product),
      (SELECT unnest(range(1, 33)) k)
    UNION ALL
    SELECT location_num, product, business_date, 0e0 FROM score_input
    SEMI JOIN (SELECT * FROM gated WHERE gate = 'stale') USING (location_num, product)
    QUALIFY row_number() OVER (PARTITION BY location_num, product ORDER BY business_date DESC) <= 32""",
)
def _(v):
    return rounded(_scores(v)[0], "forecast")


@query(
    "k23_gated_series",
    "SELECT location_num, product, rows_count, gate reason FROM gated WHERE gate = 'short'",
)
def _(v):
    return _scores(v)[1]


@query(
    "k24_zero_holidays",
    """SELECT location_num, business_date,
      CASE WHEN holiday = 1 OR sunday = 1 THEN 0 ELSE sales_sub_total END sales_sub_total,
      CASE WHEN holiday = 1 THEN 0 ELSE trans_count END trans_count
    FROM latest_sales_daily JOIN calendar_daily USING (business_date)""",
)
def _(v):
    rows = v.latest_sales_daily.join(v.calendar_daily, DAY)
    both = P.zero_holidays(
        P.zero_holidays(rows, "sales_sub_total", closed_days=True), "trans_count"
    )
    return both.select(LOC, DAY, *PAST_METRICS)


# -- limits --------------------------------------------------------------------------

_SPECIAL = (
    "business_date NOT IN (SELECT business_date FROM calendar_daily "
    "WHERE federalholiday_name <> 'Regular-day' OR holiday = 1)"
)


def _demand_sql(table: str, measure: str, where: str, window: int, versions: bool) -> str:
    newest = (
        "QUALIFY generation_date = max(generation_date) OVER "
        "(PARTITION BY location_num, business_date)"
        if versions
        else ""
    )
    return f"""
  SELECT location_num, business_date, CAST(isodow(business_date) - 1 AS INTEGER) weekday,
    CAST(sum({measure}) AS DOUBLE) demand
  FROM (SELECT * FROM {table} WHERE {_SPECIAL} AND {where} {newest})
  SEMI JOIN (SELECT DISTINCT location_num, business_date FROM {table}
    QUALIFY dense_rank() OVER (PARTITION BY location_num ORDER BY business_date DESC) <= {window})
    USING (location_num, business_date)
  GROUP BY 1, 2"""


def _limits_sql(demand: str) -> str:
    stats = "min_value, max_value, mean, median, std, iqr"
    zeros = ", ".join(f"coalesce({s}, 0e0) {s}" for s in stats.split(", "))
    return f"""
  SELECT location_num, weekday, min_value, max_value, mean,
    CASE WHEN median <= 0.15e0 * typical THEN typical ELSE median END median, std, iqr
  FROM (SELECT location_num, weekday, {zeros} FROM (
      SELECT location_num, CAST(unnest(range(6)) AS INTEGER) weekday
      FROM (SELECT DISTINCT location_num FROM {demand}))
    FULL JOIN (SELECT location_num, weekday, min(demand) min_value, max(demand) max_value,
        avg(demand) mean, median(demand) median, stddev_samp(demand) std,
        quantile_cont(demand, 0.75) - quantile_cont(demand, 0.25) iqr
      FROM {demand} GROUP BY 1, 2) USING (location_num, weekday))
  JOIN (SELECT location_num, median(m) FILTER (m <> 0) typical FROM (
      SELECT location_num, median(demand) m FROM {demand} GROUP BY location_num, weekday)
    GROUP BY 1) USING (location_num)"""


_WORKDAY = "isodow(business_date) <> 7"
V["demand_dollarsales"] = _demand_sql("sales_daily", "sales_sub_total", _WORKDAY, 56, True)
V["demand_transcount"] = _demand_sql("sales_daily", "trans_count", _WORKDAY, 35, True)
V["demand_itemcount"] = _demand_sql(
    "items_daily", "sum_daily_quantity", f"{_WORKDAY} AND product = 1", 56, True
)
V["demand_ingredient"] = _demand_sql(
    "ingredients_15min", "ingredient_quantity", "ingredient_id = 1", 56, False
)


def demand(v: Views, metric: str) -> DataFrame:
    """The metric's demand, out of its own stored tables only."""
    model, base = limits.WINDOW["LSTM"], limits.WINDOW["baseline"]
    cal, facts = v.calendar_daily, v.recent(max(model, base))
    if metric == "dollarsales":
        return limits.daily_demand(facts.sales_daily, cal, "sales_sub_total", model)
    if metric == "transcount":
        return limits.daily_demand(facts.sales_daily, cal, "trans_count", base)
    if metric == "itemcount":
        return limits.item_demand(facts.items_daily, cal, model, STAPLE_ITEM)
    return limits.ingredient_demand(facts.ingredients_15min, cal, model, STAPLE_INGREDIENT)


_STATS = ["min_value", "max_value", "mean", "median", "std", "iqr"]
_DEMANDS = ("dollarsales", "transcount", "itemcount", "ingredient")
for _m in _DEMANDS:
    V[f"limits_{_m}"] = _limits_sql(f"demand_{_m}")

    # Means of a few amounts end in a 5 at some digit; round beyond it.
    _digits = 7 if _m == "ingredient" else 6

    def _limits(v: Views, metric: str = _m, digits: int = _digits) -> DataFrame:
        return rounded(limits.weekday_limits(demand(v, metric)), *_STATS, digits=digits)

    _stats = ", ".join(f"round({s}, {_digits}) AS {s}" for s in _STATS)
    query(f"k25_limits_{_m}", f"SELECT * REPLACE ({_stats}) FROM limits_{_m}")(_limits)

V["limits_all"] = " UNION ALL ".join(
    f"SELECT location_num, weekday, '{m}' metric, median FROM limits_{m}"
    for m in _DEMANDS
)


def all_limits(v: Views) -> DataFrame:
    return v.stored("weekday_limits", lambda: _all_limits(v))


def _all_limits(v: Views) -> DataFrame:
    out = None
    for metric in _DEMANDS:
        part = limits.weekday_limits(demand(v, metric)).select(
            LOC, "weekday", F.lit(metric).alias("metric"), "median"
        )
        out = part if out is None else out.unionByName(part)
    return out


# -- documents -------------------------------------------------------------------------

#: Flavour of a document set -> suffix of its views; each has the same parts.
FLAVOURS = {"short": "", "long": "_long", "redundancy": "_redundancy", "fallback": "_fallback"}
V["fallback_pairs"] = """
  SELECT DISTINCT location_num, business_date + 364 business_date, forecast_type
  FROM deferred_sales_15min JOIN location_list USING (location_num)"""


def _routed_sql(modelled: str, baseline_rows: str) -> str:
    """The forecast of each pair, out of the table of its store's type."""

    def of(kind: str) -> str:
        return (
            f"SEMI JOIN (SELECT * FROM fallback_pairs WHERE forecast_type = '{kind}') "
            "USING (location_num, business_date)"
        )

    return f"SELECT * FROM {modelled} {of('LSTM')} UNION ALL {baseline_rows} {of('baseline')}"


V["fallback_15min"] = _routed_sql(
    "forecast_15min_short",
    """SELECT location_num, business_date, "interval" interval_start_time,
      forecast_sales_sub_total forecast, forecast_trans_count forecast_tx, generation_date
    FROM baseline_metrics""",
)
V["fallback_items_15min"] = _routed_sql(
    "forecast_items_15min_short",
    """SELECT location_num, business_date, product item_id, "interval" interval_start_time,
      forecast_sum_daily_quantity forecast, generation_date FROM baseline_items""",
)
V["fallback_ingredients_15min"] = _routed_sql(
    "forecast_ingredients_15min_short",
    """SELECT location_num, business_date, ingredient_id, "interval" interval_start_time,
      sumingredient forecast, generation_date FROM baseline_ingredients""",
)


def _forecast_view(flavour: str, part: str = "") -> str:
    return f"fallback_{part}15min" if flavour == "fallback" else f"forecast_{part}15min_{flavour}"


def _newest_sql(table: str, dates: str) -> str:
    return (
        f"(SELECT * FROM (SELECT * FROM {table} SEMI JOIN {dates} "
        "USING (location_num, business_date)) QUALIFY generation_date = max(generation_date) "
        "OVER (PARTITION BY location_num, business_date))"
    )


def _ly_sql(table: str, columns: str, dates: str) -> str:
    return (
        f"(SELECT d.location_num, d.business_date, {columns} FROM {table} t JOIN {dates} d "
        "ON d.location_num = t.location_num AND d.ly_date = t.business_date)"
    )


_TIME = "strftime(t.timequarter, '%H:%M:%S')"


def _codes_sql(forecast: str, code: str, facts: str, fact_code: str, amount: str, dates: str) -> str:
    return f"""
  SELECT DISTINCT location_num, business_date, CAST({code} AS VARCHAR) code,
    concat(CAST(business_date AS VARCHAR), 'T', time) intervalstart, '3' servicetype,
    {dec2("coalesce(forecast, 0e0)")} transactioncount, amount lastyearcount
  FROM (SELECT DISTINCT location_num, business_date, {code}, time, coalesce(amount, 0) amount
    FROM (SELECT DISTINCT location_num, business_date, {code}, g."interval" AS time
      FROM {forecast} SEMI JOIN {dates} USING (location_num, business_date), time_grid g)
    LEFT JOIN {_ly_sql(facts, f"t.{fact_code} AS {code}, {_TIME} AS time, {amount} amount", dates)} l
      USING (location_num, business_date, {code}, time))
  LEFT JOIN (SELECT location_num, business_date, {code}, interval_start_time AS time, forecast
    FROM {_newest_sql(forecast, dates)} f) USING (location_num, business_date, {code}, time)
  WHERE NOT coalesce(forecast = 0 AND amount = 0, false)"""


def _document_views(flavour: str, tag: str) -> None:
    dates, metrics = f"doc_dates{tag}", _forecast_view(flavour)
    pairs = (
        "(SELECT DISTINCT location_num, business_date FROM fallback_pairs)"
        if flavour == "fallback"
        else f"(SELECT DISTINCT location_num, business_date FROM {_latest(metrics)} f)"
    )
    V[dates] = f"SELECT *, {last_year('CAST(business_date AS DATE)')} ly_date FROM {pairs}"
    V[f"doc_header{tag}"] = f"""
  SELECT DISTINCT location_num, business_date,
    lpad(CAST(location_num AS VARCHAR), 5, '0') storenumber,
    concat(CAST(business_date AS VARCHAR), 'T00:00:00') businessday, 'true' readonly,
    'Net Sales' forecastbasis, {dec2("coalesce(forecast, 0e0)")} sales,
    {dec2("coalesce(forecast_tx, 0e0)")} transactioncount,
    CAST(coalesce(sales_sub_total, 0) AS DECIMAL(18,2)) lastyearsales,
    CAST(coalesce(trans_count, 0) AS DECIMAL(18,2)) lastyeartransactioncount
  FROM (SELECT location_num, business_date, round(sum(forecast), 4) forecast,
      sum(forecast_tx) forecast_tx FROM {_newest_sql(metrics, dates)} f GROUP BY 1, 2)
  FULL JOIN {_ly_sql("latest_sales_daily", "t.sales_sub_total, t.trans_count", dates)} l
    USING (location_num, business_date)"""
    V[f"doc_metrics{tag}"] = f"""
  SELECT DISTINCT location_num, business_date,
    concat(CAST(business_date AS VARCHAR), 'T', time) intervalstart, '3' servicetype,
    {dec2("coalesce(forecast, 0e0)")} sales, {dec2("coalesce(forecast_tx, 0e0)")} transactioncount,
    CAST(coalesce(sales_sub_total, 0) AS DECIMAL(18,2)) lastyearsales,
    CAST(coalesce(trans_count, 0) AS DECIMAL(18,2)) lastyeartransactioncount
  FROM (SELECT *, interval_start_time AS time FROM {_newest_sql(metrics, dates)} f)
  FULL JOIN {_ly_sql("sales_15min", f"{_TIME} AS time, t.sales_sub_total, t.trans_count", dates)} l
    USING (location_num, business_date, time)
  WHERE NOT coalesce(forecast = 0 AND forecast_tx = 0 AND sales_sub_total = 0
    AND trans_count = 0, false)"""
    V[f"doc_deferred_metrics{tag}"] = f"""
  SELECT location_num, business_date,
    concat(CAST(business_date AS VARCHAR), 'T', time) intervalstart, '2' servicetype,
    CAST(0 AS DECIMAL(18,2)) sales, CAST(0 AS DECIMAL(18,2)) transactioncount,
    sales_sub_total lastyearsales, trans_count lastyeartransactioncount
  FROM {_ly_sql("deferred_sales_15min", f"{_TIME} AS time, t.sales_sub_total, t.trans_count", dates)} l
  WHERE NOT (sales_sub_total = 0 AND trans_count = 0)"""
    V[f"doc_items{tag}"] = _codes_sql(
        _forecast_view(flavour, "items_"), "item_id", "items_15min", "product", "t.sum_daily_quantity", dates
    )
    V[f"doc_ingredients{tag}"] = _codes_sql(
        _forecast_view(flavour, "ingredients_"),
        "ingredient_id",
        "ingredients_15min",
        "ingredient_id",
        dec2("t.ingredient_quantity"),
        dates,
    )
    V[f"doc_deferred_items{tag}"] = f"""
  SELECT location_num, business_date, CAST(product AS VARCHAR) code,
    concat(CAST(business_date AS VARCHAR), 'T', time) intervalstart, '2' servicetype,
    CAST(0 AS DECIMAL(18,2)) transactioncount, sum_daily_quantity lastyearcount
  FROM {_ly_sql("deferred_items_15min", f"t.product, {_TIME} AS time, t.sum_daily_quantity", dates)} l
  WHERE sum_daily_quantity <> 0"""


for _flavour, _tag in FLAVOURS.items():
    _document_views(_flavour, _tag)


def fallback_pairs(v: Views) -> DataFrame:
    """The pairs asked for, each with its store's forecast type."""
    asked = v.deferred_sales_15min.select(LOC, F.date_add(DAY, 364).alias(DAY)).distinct()
    return asked.join(v.location_list, LOC)


class Documents:
    """The parts of one flavour's documents; ``stored`` reads them as tables."""

    def __init__(self, v: Views, flavour: str = "short", stored: bool = False):
        self.v, self.flavour, self.stored = v, flavour, stored

    def _table(self, name: str, build) -> DataFrame:
        return self.v.stored(f"{name}{FLAVOURS[self.flavour]}", build, LOC, DAY)

    def _forecast(self, part: str = "") -> DataFrame:
        v = self.v
        if self.flavour != "fallback":
            return getattr(v, f"forecast_{part}15min")(self.flavour)
        time = F.col("interval").alias("interval_start_time")
        if part == "items_":
            rows = v.stored("baseline_items", lambda: k04(v), LOC, DAY)
            codes = [F.col("product").alias("item_id")]
            values = [F.col("forecast_sum_daily_quantity").alias("forecast")]
        elif part == "ingredients_":
            rows = v.stored("baseline_ingredients", lambda: k05(v), LOC, DAY)
            codes, values = ["ingredient_id"], [F.col("sumingredient").alias("forecast")]
        else:
            rows, codes = v.stored("baseline_metrics", lambda: k03(v), LOC, DAY), []
            values = [
                F.col("forecast_sales_sub_total").alias("forecast"),
                F.col("forecast_trans_count").alias("forecast_tx"),
            ]
        by_type = {
            "LSTM": getattr(v, f"forecast_{part}15min")("short"),
            "baseline": rows.select(LOC, DAY, *codes, time, *values, GEN),
        }
        return delivery.routed(self._table("pairs", lambda: fallback_pairs(v)), by_type)

    def _part(self, name: str) -> DataFrame:
        v = self.v
        if self.stored:
            return self._table(f"doc_{name}", lambda: getattr(Documents(v, self.flavour), name))
        if self.flavour == "fallback":
            dates = self._table("delivery_dates", lambda: delivery.fallback_dates(fallback_pairs(v)))
        else:
            dates = self._table("delivery_dates", lambda: delivery.delivery_dates(self._forecast()))
        # A fallback's dates reach over all of history, the others' over their horizon.
        facts = v if self.flavour == "fallback" else v.near
        if name == "header":
            return delivery.doc_header(self._forecast(), facts.latest_sales_daily, dates)
        if name == "metrics":
            return delivery.doc_metrics(self._forecast(), facts.sales_15min, dates)
        if name == "deferred_metrics":
            return delivery.doc_deferred_metrics(facts.deferred_sales_15min, dates)
        if name == "items":
            return delivery.doc_items(self._forecast("items_"), facts.items_15min, dates)
        if name == "deferred_items":
            return delivery.doc_deferred_items(facts.deferred_items_15min, dates)
        return delivery.doc_ingredients(self._forecast("ingredients_"), facts.ingredients_15min, dates)

    header = property(lambda self: self._part("header"))
    metrics = property(lambda self: self._part("metrics"))
    deferred_metrics = property(lambda self: self._part("deferred_metrics"))
    items = property(lambda self: self._part("items"))
    deferred_items = property(lambda self: self._part("deferred_items"))
    ingredients = property(lambda self: self._part("ingredients"))

    def build(self, summary: bool = False) -> DataFrame:
        return delivery.build_documents(
            self.header,
            self.metrics.unionByName(self.deferred_metrics),
            self.items.unionByName(self.deferred_items),
            self.ingredients,
            f"{AS_OF}T00:00:00.000Z",
            summary,
        )


for _name, _attr in {
    "k26_doc_header": "header",
    "k27_doc_metrics": "metrics",
    "k28_doc_items": "items",
    "k29_doc_ingredients": "ingredients",
    "k30_doc_deferred_metrics": "deferred_metrics",
    "k30_doc_deferred_items": "deferred_items",
}.items():

    def _part(v: Views, attr: str = _attr) -> DataFrame:
        return getattr(Documents(v), attr)

    query(_name, f"SELECT * FROM doc_{_attr}")(_part)


def _nested(rows: str, columns: dict[str, str], order: str, name: str) -> str:
    texts = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns.values())
    return (
        "SELECT location_num, business_date, "
        f"string_agg(concat_ws('|', {texts}), ';' ORDER BY {order}) {name} "
        f"FROM ({rows}) GROUP BY 1, 2"
    )


def _lines_view(tag: str) -> None:
    metrics = _nested(
        f"SELECT * FROM doc_metrics{tag} UNION ALL SELECT * FROM doc_deferred_metrics{tag}",
        delivery._METRIC,
        "servicetype, intervalstart, sales, transactioncount, lastyearsales, lastyeartransactioncount",
        "metric_lines",
    )
    order = "servicetype, code, intervalstart, transactioncount, lastyearcount"
    counts = {"code": "code", **delivery._COUNTS}
    items = f"SELECT * FROM doc_items{tag} UNION ALL SELECT * FROM doc_deferred_items{tag}"
    V[f"document_lines{tag}"] = f"""
  SELECT h.*, coalesce(metric_lines, '') metric_lines, coalesce(item_lines, '') item_lines,
    coalesce(ingredient_lines, '') ingredient_lines
  FROM doc_header{tag} h
  LEFT JOIN ({metrics}) m USING (location_num, business_date)
  LEFT JOIN ({_nested(items, counts, order, "item_lines")}) i USING (location_num, business_date)
  LEFT JOIN ({_nested(f"SELECT * FROM doc_ingredients{tag}", counts, order, "ingredient_lines")}) g
    USING (location_num, business_date)"""


for _tag in FLAVOURS.values():
    _lines_view(_tag)


def flat_document(documents: DataFrame) -> DataFrame:
    """Documents as text columns that both engines can compare."""

    def joined(name: str, fields: list[str]):
        return F.array_join(
            F.transform(
                F.col(f"Forecast.{name}"),
                lambda r: F.concat_ws("|", *[r[f] for f in fields]),
            ),
            ";",
        )

    head = [
        F.col(f"Forecast.{n}").alias(n.lower())
        for n in delivery._HEADER
    ]
    counts = list(delivery._COUNTS)
    return documents.select(
        LOC,
        DAY,
        *head,
        joined("MetricDetail", list(delivery._METRIC)).alias("metric_lines"),
        joined("SalesItemDetail", ["SalesItemCode", *counts]).alias("item_lines"),
        joined("InventoryItemDetail", ["ItemCode", *counts]).alias("ingredient_lines"),
    )


_DOC_TEXT = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}"
    for c in ("sales", "transactioncount", "lastyearsales", "lastyeartransactioncount")
)


for _flavour, _tag in FLAVOURS.items():

    def _whole(v: Views, flavour: str = _flavour) -> DataFrame:
        return flat_document(Documents(v, flavour, stored=True).build())

    _name = "k31_documents" if _flavour == "short" else f"k31_{_flavour}_documents"
    query(_name, f"SELECT * REPLACE ({_DOC_TEXT}) FROM document_lines{_tag}")(_whole)


@query(
    "k31_summary_documents",
    f"SELECT * REPLACE ({_DOC_TEXT}, '' AS item_lines, '' AS ingredient_lines) "
    "FROM document_lines",
)
def _(v):
    return flat_document(Documents(v, stored=True).build(summary=True))


@query(
    "k31_fallback_dates",
    f"""SELECT DISTINCT location_num, business_date + 364 business_date,
      {last_year("CAST(business_date + 364 AS DATE)")} ly_date FROM deferred_sales_15min""",
)
def _(v):
    return delivery.fallback_dates(
        v.deferred_sales_15min.select(LOC, F.date_add(DAY, 364).alias(DAY))
    )

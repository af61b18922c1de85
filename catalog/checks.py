"""Quality checks (Q rows) beside their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.forecasts import FLAVOURS, Documents, _latest, all_limits, k01, k02
from catalog.registry import query
from catalog.views import (
    AS_OF,
    DAY,
    GEN,
    LOC,
    STAPLE_INGREDIENT,
    STAPLE_ITEM,
    Views,
)
from catalog.views_sql import AS_OF as TODAY
from catalog.views_sql import VIEWS_SQL as V
from catalog.views_sql import closed_holiday
from tillcast.functions.calendar import HORIZONS, horizon_dates
from tillcast.operators import aggregates as A
from tillcast.plans import document_checks as D
from tillcast.plans import forecast_checks as C
from tillcast.plans import load_checks as L


def _sum(measure: str, cast_first: bool = False) -> str:
    inner = f"CAST({measure} AS DECIMAL(18,2))" if cast_first else measure
    return f"CAST(sum({inner}) AS DECIMAL(18,2))"


def _totals(table: str, names: dict[str, str], extra: str = "") -> str:
    sums = ", ".join(f"{_sum(m)} {n}" for n, m in names.items())
    return f"(SELECT location_num, {sums}{extra} FROM {table} GROUP BY 1)"


_LOADED = ", max(business_date) business_date_max, max(generation_date) dataprep_generation_date"
_M = {"sales": "sales_sub_total", "trans": "trans_count"}


def _named(tag: str) -> dict[str, str]:
    return {f"{k}_{tag}": m for k, m in _M.items()}


# -- loads and preparation ---------------------------------------------------------

V["reconciled_metrics"] = f"""
  SELECT *, CASE WHEN sales_daily <> sales_daily_qc OR trans_daily <> trans_daily_qc
      OR sales_15min <> sales_15min_qc OR trans_15min <> trans_15min_qc THEN 0 ELSE 1 END dailyqc,
    {TODAY} generation_date
  FROM {_totals(_latest("sales_daily") + " n", _named("daily"), _LOADED)}
  JOIN {_totals(_latest("control_sales_daily") + " n", _named("daily_qc"))} USING (location_num)
  JOIN {_totals(_latest("sales_15min") + " n", _named("15min"))} USING (location_num)
  JOIN {_totals(_latest("control_sales_15min") + " n", _named("15min_qc"))}
    USING (location_num)"""
_Q = "sum_daily_quantity"
V["reconciled_items"] = f"""
  SELECT *, CASE WHEN quantity_daily <> quantity_15min_qc OR quantity_15min <> quantity_daily_qc
      THEN 0 ELSE 1 END dailyqc, {TODAY} generation_date
  FROM {_totals(_latest("items_daily") + " n", {"quantity_daily": _Q}, _LOADED)}
  JOIN {_totals(_latest("control_items_daily") + " n", {"quantity_daily_qc": _Q})}
    USING (location_num)
  JOIN {_totals(_latest("items_15min") + " n", {"quantity_15min": _Q})} USING (location_num)
  JOIN {_totals(_latest("control_items_15min") + " n", {"quantity_15min_qc": _Q})}
    USING (location_num)"""


def q01(v: Views) -> DataFrame:
    return L.reconcile_metrics(
        v.sales_daily,
        v.control_sales(v.sales_daily),
        v.sales_15min,
        v.control_sales(v.sales_15min),
        AS_OF,
        (v.versions("sales_daily", v.sales_daily), v.versions("sales_15min", v.sales_15min)),
    )


def q02(v: Views) -> DataFrame:
    return L.reconcile_items(
        v.items_daily,
        v.control_items(v.items_daily),
        v.items_15min,
        v.control_items(v.items_15min),
        AS_OF,
        (v.versions("items_daily", v.items_daily), v.versions("items_15min", v.items_15min)),
    )


query("q01_reconcile_metrics", "SELECT * FROM reconciled_metrics")(q01)
query("q02_reconcile_items", "SELECT * FROM reconciled_items")(q02)


def _at(table: str, daily: str) -> str:
    return (
        f"(SELECT * FROM {table} SEMI JOIN (SELECT location_num, max(generation_date) "
        f"generation_date FROM {daily} GROUP BY 1) USING (location_num, generation_date)) n"
    )


@query(
    "q03_prep_check_metrics",
    f"""SELECT *, CASE WHEN sales_daily_initial <> sales_daily_final
        OR trans_daily_initial <> trans_daily_final OR sales_15min_initial <> sales_15min_final
        OR trans_15min_initial <> trans_15min_final THEN 0 ELSE 1 END dailyqc,
      {TODAY} generation_date
    FROM {_totals(_latest("sales_daily") + " n", _named("daily_initial"),
                  ", max(generation_date) dataprep_generation_date")}
    JOIN {_totals(_latest("latest_sales_daily") + " n", _named("daily_final"),
                  ", max(business_date) business_date_max")} USING (location_num)
    JOIN {_totals(_at("sales_15min", "sales_daily"), _named("15min_initial"))} USING (location_num)
    JOIN {_totals(_at("latest_sales_15min", "latest_sales_daily"), _named("15min_final"))}
      USING (location_num)""",
)
def _(v):
    return L.prep_check_metrics(
        v.sales_daily, v.latest_sales_daily, v.sales_15min, v.latest_sales_15min, AS_OF
    )


@query(
    "q04_prep_check_items",
    f"""SELECT *, CASE WHEN quantity_daily_initial <> quantity_daily_final
        OR quantity_15min_initial <> coalesce(quantity_15min_final, 0)
        OR quantity_15min_initial <> quantity_daily_initial THEN 0 ELSE 1 END dailyqc,
      {TODAY} generation_date
    FROM {_totals(_latest("items_daily") + " n", {"quantity_daily_initial": _Q},
                  ", max(generation_date) dataprep_generation_date")}
    JOIN {_totals(_at("items_15min", "items_daily"), {"quantity_15min_initial": _Q})}
      USING (location_num)
    JOIN {_totals(_latest("latest_items_daily") + " n", {"quantity_daily_final": _Q},
                  ", max(business_date) business_date_max")} USING (location_num)
    LEFT JOIN {_totals(_at("latest_items_15min", "latest_items_daily"),
                       {"quantity_15min_final": _Q})} USING (location_num)""",
)
def _(v):
    return L.prep_check_items(
        v.items_daily, v.latest_items_daily, v.items_15min, v.latest_items_15min, AS_OF
    )


# -- forecasts -----------------------------------------------------------------------

V["run_dates"] = (
    "SELECT location_num, max(generation_date) run_date FROM forecast_sales_short GROUP BY 1"
)


def runs(v: Views) -> DataFrame:
    return C.run_dates(v.forecast_sales("short"))


def _q05_sql(horizon: str, rows: int, redundancy: bool) -> str:
    first, last = HORIZONS[horizon]
    sales, trans = f"forecast_sales_{horizon}", f"forecast_trans_{horizon}"
    high = sales if redundancy else trans
    return f"""
  SELECT DISTINCT CASE WHEN a.sales_rows IS NOT NULL THEN generation_date END
      forecast_generation_date,
    CASE WHEN a.sales_rows IS NOT NULL THEN business_date END business_date,
    CASE WHEN a.sales_rows IS NOT NULL THEN location_num END location_num,
    {TODAY} generation_date,
    CASE WHEN low <> run_date + {first} OR high <> run_date + {last} OR trans_rows <> {rows}
      OR sales_rows <> {rows} THEN 0 ELSE 1 END forecast_qc
  FROM (SELECT location_num, generation_date, business_date, count(*) sales_rows
      FROM {_latest(sales)} s GROUP BY 1, 2, 3) a
  {"JOIN" if redundancy else "FULL JOIN"} (SELECT location_num, generation_date, business_date,
      count(*) trans_rows FROM {_at(trans, sales)} GROUP BY 1, 2, 3) c
    USING (location_num, generation_date, business_date)
  LEFT JOIN (SELECT location_num, min(business_date) low FROM {_latest(sales)} s GROUP BY 1)
    USING (location_num)
  LEFT JOIN (SELECT location_num, max(business_date) high FROM {_latest(high)} s GROUP BY 1)
    USING (location_num)
  LEFT JOIN run_dates USING (location_num)"""


def _q06_sql(table: str, horizon: str, rows: int) -> str:
    first, last = HORIZONS[horizon]
    return f"""
  SELECT generation_date forecast_generation_date, business_date, location_num,
    {TODAY} generation_date,
    CASE WHEN low <> run_date + {first} OR high <> run_date + {last} OR n <> {rows}
      THEN 0 ELSE 1 END forecast_qc
  FROM (SELECT location_num, generation_date, business_date, count(*) n
      FROM {_latest(table)} s GROUP BY 1, 2, 3)
  JOIN (SELECT location_num, min(business_date) low, max(business_date) high
      FROM {_latest(table)} s GROUP BY 1) USING (location_num)
  LEFT JOIN run_dates USING (location_num)"""


def _q07_sql(table: str, horizon: str, rows: int) -> str:
    first, last = HORIZONS[horizon]
    return f"""
  SELECT generation_date forecast_generation_date, business_date, products expected_items,
    actual_items, location_num, {TODAY} generation_date,
    CASE WHEN actual_items < products OR low <> run_date + {first} OR high <> run_date + {last}
      OR actual_items * {rows} <> n THEN 0 ELSE 1 END forecast_qc
  FROM (SELECT location_num, generation_date, business_date, count(*) n,
      count(DISTINCT item_id) actual_items FROM {_latest(table)} s GROUP BY 1, 2, 3)
  JOIN (SELECT location_num, min(business_date) low, max(business_date) high
      FROM {_latest(table)} s GROUP BY 1) USING (location_num)
  LEFT JOIN run_dates USING (location_num)
  LEFT JOIN expected_products USING (location_num)"""


for _h in ("short", "long"):
    V[f"check_metrics_{_h}"] = _q05_sql(_h, 1, False)
    V[f"check_15min_{_h}"] = _q06_sql(f"forecast_15min_{_h}", _h, 96)
    V[f"check_items_{_h}"] = _q07_sql(f"forecast_items_{_h}", _h, 1)
    V[f"check_items_15min_{_h}"] = _q07_sql(f"forecast_items_15min_{_h}", _h, 96)
V["check_metrics_redundancy"] = _q05_sql("redundancy", 1, True)
V["check_items_redundancy"] = _q07_sql("forecast_items_redundancy", "redundancy", 1)


def check_metrics(v: Views, h: str) -> DataFrame:
    sales, trans = v.forecast_sales(h), v.forecast_trans(h)
    return C.forecast_check_metrics(
        sales,
        trans,
        runs(v),
        h,
        AS_OF,
        redundancy=h == "redundancy",
        versions=(v.versions(f"forecast_sales_{h}", sales), v.versions(f"forecast_trans_{h}", trans)),
    )


def check_items(v: Views, h: str) -> DataFrame:
    items = v.forecast_items(h)
    versions = v.versions(f"forecast_items_{h}", items)
    return C.forecast_check_items(items, v.expected_products, runs(v), h, AS_OF, versions=versions)


for _h in HORIZONS:
    query(f"q05_forecast_check_metrics_{_h}", f"SELECT * FROM check_metrics_{_h}")(
        lambda v, h=_h: check_metrics(v, h)
    )
    query(f"q07_forecast_check_items_{_h}", f"SELECT * FROM check_items_{_h}")(
        lambda v, h=_h: check_items(v, h)
    )


@query("q06_forecast_check_15min", "SELECT * FROM check_15min_short")
def _(v):
    return C.forecast_check_15min(v.forecast_15min("short"), runs(v), "short", AS_OF)


@query("q07_forecast_check_items_15min", "SELECT * FROM check_items_15min_short")
def _(v):
    return C.forecast_check_items(
        v.forecast_items_15min("short"), v.expected_products, runs(v), "short", AS_OF, 96
    )


def _newest_all(table: str) -> str:
    return (
        f"(SELECT * FROM {table} WHERE generation_date = "
        f"(SELECT max(generation_date) FROM {table})) n"
    )


def _q08_sql(horizon: str) -> str:
    first, last = HORIZONS[horizon]
    sales, trans = f"forecast_sales_{horizon}", f"forecast_trans_{horizon}"
    return f"""SELECT generation_date forecast_generation_date, business_date,
      expected_locations, actual_locations, n row_count, {TODAY} generation_date,
      CASE WHEN n <> trans_n OR actual_locations < expected_locations
        OR trans_locations <> actual_locations
        OR (SELECT min(business_date) FROM {_newest_all(sales)}) <> {TODAY} + {first}
        OR (SELECT max(business_date) FROM {_newest_all(sales)}) <> {TODAY} + {last}
        THEN 0 ELSE 1 END forecast_qc
    FROM (SELECT business_date, generation_date, count(DISTINCT location_num) actual_locations,
        count(*) n FROM {_newest_all(sales)} GROUP BY 1, 2)
    JOIN (SELECT business_date, generation_date, count(DISTINCT location_num) trans_locations,
        count(*) trans_n FROM {trans} GROUP BY 1, 2) USING (business_date, generation_date),
      (SELECT count(DISTINCT location_num) expected_locations FROM sales_daily)"""


def expected_locations(v: Views) -> DataFrame:
    return v.sales_daily.agg(F.countDistinct(LOC).alias("expected_locations"))


for _h in ("short", "long"):
    query(f"q08_forecast_check_chain_{_h}", _q08_sql(_h))(
        lambda v, h=_h: C.forecast_check_chain(
            v.forecast_sales(h), v.forecast_trans(h), expected_locations(v), h, AS_OF
        )
    )


@query(
    "q08_forecast_check_chain_items",
    f"""SELECT generation_date forecast_generation_date, business_date, expected_locations,
      expected_items, actual_items, actual_locations, {TODAY} generation_date,
      CASE WHEN actual_items < expected_items OR actual_locations < expected_locations
        OR (SELECT min(business_date) FROM {_newest_all("forecast_items_short")})
          <> {TODAY} + 16
        OR (SELECT max(business_date) FROM {_newest_all("forecast_items_short")})
          <> {TODAY} + 19 THEN 0 ELSE 1 END forecast_qc
    FROM (SELECT business_date, generation_date, count(DISTINCT item_id) actual_items,
        count(DISTINCT location_num) actual_locations
      FROM {_newest_all("forecast_items_short")} GROUP BY 1, 2),
      (SELECT count(DISTINCT location_num) expected_locations FROM sales_daily),
      (SELECT count(*) expected_items FROM (SELECT DISTINCT product FROM combinations))""",
)
def _(v):
    return C.forecast_check_chain_items(
        v.forecast_items("short"),
        v.combinations.select("product").distinct(),
        expected_locations(v),
        "short",
        AS_OF,
    )


V["baseline_checked"] = f"""
  SELECT location_num, prediction_date business_date, dates_qc, trend_qc,
    least(dates_qc, trend_qc) forecast_qc, {TODAY} generation_date
  FROM (SELECT s.location_num, s.prediction_date,
      CASE WHEN coalesce(ok, true) THEN 1 ELSE 0 END dates_qc,
      CASE WHEN coalesce(trends = 1, false) THEN 1 ELSE 0 END trend_qc
    FROM control s
    LEFT JOIN (SELECT location_num, prediction_date,
        count(DISTINCT business_date) <= lookup_weeks - 3
          AND count(DISTINCT business_date) = forecast_avg_dr
          AND isodow(prediction_date) <> 7 AND NOT {closed_holiday("prediction_date")}
          AND NOT (isodow(prediction_date) = 6
            AND location_num IN (SELECT location_num FROM saturday_off)) ok
      FROM baseline_dates GROUP BY location_num, prediction_date, lookup_weeks, forecast_avg_dr)
      USING (location_num, prediction_date)
    LEFT JOIN (SELECT location_num, prediction_date, count(trend) trends FROM baseline_trend
      GROUP BY 1, 2) USING (location_num, prediction_date))"""


def q09(v: Views) -> DataFrame:
    return C.baseline_check(v.stores, k01(v), k02(v), v.saturday_off, AS_OF)


query("q09_baseline_check", "SELECT * FROM baseline_checked")(q09)


@query(
    "q09_baseline_verdict",
    "SELECT location_num, min(forecast_qc) forecast_qc FROM baseline_checked GROUP BY 1",
)
def _(v):
    return C.baseline_verdict(q09(v))


def _flagged(tables: list[str], value: int, store: str = "location_num") -> str:
    return " UNION ".join(
        f"SELECT DISTINCT {store} location_num FROM {_newest_all(t)} WHERE forecast_qc = {value}"
        for t in tables
    )


_ITEM_CHECKS = ["check_items_short", "check_items_long"]
_METRIC_CHECKS = ["check_metrics_short", "check_metrics_long"]
V["failed_stores"] = (
    f"{_flagged(_ITEM_CHECKS, 0)} UNION {_flagged(_METRIC_CHECKS, 0, 'coalesce(location_num, 0)')}"
)
V["passed_both"] = f"""
  SELECT location_num FROM ({_flagged(_ITEM_CHECKS, 1)})
  JOIN ({_flagged(_METRIC_CHECKS, 1)}) USING (location_num)"""


def _check_tables(v: Views) -> tuple[list[DataFrame], list[DataFrame]]:
    return _stored_checks(v, "short", "long")


def _stored_checks(v: Views, *horizons: str) -> tuple[list[DataFrame], list[DataFrame]]:
    items = [v.stored(f"check_items_{h}", lambda h=h: check_items(v, h)) for h in horizons]
    metrics = [v.stored(f"check_metrics_{h}", lambda h=h: check_metrics(v, h)) for h in horizons]
    return items, metrics


@query("q10_failed_stores", "SELECT * FROM failed_stores")
def _(v):
    return C.failed_stores(*_check_tables(v))


_PADDED = "SELECT lpad(CAST(location_num AS VARCHAR), 5, '0') store_number"


@query(
    "q10_passed_stores",
    f"{_PADDED} FROM passed_both WHERE location_num NOT IN (SELECT location_num FROM failed_stores)",
)
def _(v):
    return C.passed_stores(*_check_tables(v))


_PASSED_REDUNDANCY = f"""{_PADDED} FROM ({_flagged(["check_items_redundancy"], 1)})
      JOIN ({_flagged(["check_metrics_redundancy"], 1)}) USING (location_num)
      WHERE location_num NOT IN ({_flagged(["check_items_redundancy"], 0)} UNION
        {_flagged(["check_metrics_redundancy"], 0, "coalesce(location_num, 0)")})"""


@query(
    "q10_passed_stores_baseline",
    f"""{_PASSED_REDUNDANCY} AND location_num NOT IN
      (SELECT location_num FROM location_list WHERE forecast_type = 'LSTM')""",
)
def _(v):
    modelled = v.location_list.where("forecast_type = 'LSTM'")
    return C.passed_stores(*_stored_checks(v, "redundancy"), modelled=modelled)


@query("q10_passed_stores_redundancy", _PASSED_REDUNDANCY)
def _(v):
    return C.passed_stores(*_stored_checks(v, "redundancy"))


# -- documents -----------------------------------------------------------------------

_ITEM, _INGREDIENT = str(STAPLE_ITEM), str(STAPLE_INGREDIENT)
def _flat_sql(rows: str, value: str, name: str, where: str = "true") -> str:
    return f"""(SELECT location_num, business_date,
      CASE WHEN count(*) = 2 AND arg_max(n, seen) = 65 THEN 1 ELSE 0 END {name}
    FROM (SELECT location_num, business_date, {value}, count(*) n,
        min(concat(servicetype, intervalstart)) seen
      FROM {rows} WHERE {where} GROUP BY 1, 2, 3) GROUP BY 1, 2)"""


_KEY = "USING (location_num, business_date)"


def _total_sql(rows: str, metric: str, measure: str, checked: str = "true") -> str:
    return f"""SELECT location_num, business_date, '{metric}' metric,
      CAST(sum(CASE WHEN {checked} THEN {measure} ELSE 0 END) AS DOUBLE) total,
      CAST(sum({measure}) AS DOUBLE) sunday_total FROM {rows} GROUP BY 1, 2"""


_NAMES = [
    "generated_successfully",
    "sunday_zeros",
    "less_than_min",
    "less_than_90_min",
    "greater_than_max",
    "greater_than_15_max",
]
_MEASURED = {"val": "total", "min_limit": "min_limit", "max_limit": "max_limit"}
def _check_views(tag: str) -> None:
    """Flags, totals, limits and alerts over the documents of one flavour."""
    metrics, items, ingredients = f"all_doc_metrics{tag}", f"all_doc_items{tag}", f"doc_ingredients{tag}"
    V[metrics] = f"SELECT * FROM doc_metrics{tag} UNION ALL SELECT * FROM doc_deferred_metrics{tag}"
    V[items] = f"SELECT * FROM doc_items{tag} UNION ALL SELECT * FROM doc_deferred_items{tag}"
    item, ingredient = f"code = '{_ITEM}'", f"code = '{_INGREDIENT}'"
    V[f"flat_flags{tag}"] = f"""
  SELECT location_num, business_date,
    coalesce(dollarsales_flat, 0) dollarsales_flat, coalesce(transcount_flat, 0) transcount_flat,
    coalesce(itemcount_flat, 0) itemcount_flat, coalesce(ingredient_flat, 0) ingredient_flat
  FROM doc_header{tag}
  LEFT JOIN {_flat_sql(metrics, "sales", "dollarsales_flat")} {_KEY}
  LEFT JOIN {_flat_sql(metrics, "transactioncount", "transcount_flat")} {_KEY}
  LEFT JOIN {_flat_sql(items, "transactioncount", "itemcount_flat", item)} {_KEY}
  LEFT JOIN {_flat_sql(ingredients, "transactioncount", "ingredient_flat", ingredient)} {_KEY}"""
    V[f"document_totals{tag}"] = " UNION ALL ".join(
        [
            _total_sql(metrics, "dollarsales", "sales"),
            _total_sql(metrics, "transcount", "transactioncount"),
            _total_sql(items, "itemcount", "transactioncount", item),
            _total_sql(ingredients, "ingredient", "transactioncount", ingredient),
        ]
    )
    V[f"limit_flags{tag}"] = f"""
  SELECT location_num, business_date, metric, total, min_limit, max_limit,
    CASE WHEN sunday THEN 0 ELSE 1 END generated_successfully,
    CASE WHEN sunday AND sunday_total <> 0 THEN 0 ELSE 1 END sunday_zeros,
    CASE WHEN NOT sunday AND under THEN 1 ELSE 0 END less_than_min,
    CASE WHEN NOT sunday AND under AND far_under THEN 1 ELSE 0 END less_than_90_min,
    CASE WHEN NOT sunday AND above THEN 1 ELSE 0 END greater_than_max,
    CASE WHEN NOT sunday AND above AND far_above THEN 1 ELSE 0 END greater_than_15_max,
    CASE WHEN (sunday AND sunday_total <> 0) OR (NOT sunday
      AND ((under AND far_under) OR (above AND far_above))) THEN 1 ELSE 0 END failed,
    CASE WHEN NOT sunday AND ((under AND NOT far_under) OR (above AND NOT far_above))
      THEN 1 ELSE 0 END warned
  FROM (SELECT *, isodow(business_date) = 7 sunday, total <= greatest(0e0, min_limit) under,
      total <= greatest(0e0, min_limit * 0.9e0) far_under,
      NOT total <= greatest(0e0, min_limit) AND total >= max_limit above,
      total >= max_limit * 1.5e0 far_above
    FROM document_totals{tag} t LEFT JOIN (SELECT location_num l, weekday, metric m,
        median - 0.35e0 * median min_limit, median + 0.35e0 * median max_limit FROM limits_all)
      ON l = location_num AND weekday = isodow(business_date) - 1 AND m = metric)"""
    V[f"alerts{tag}"] = f"""
  SELECT f.*, {", ".join(f"{m}_{n}" for m in D.METRICS for n in [*_NAMES, *_MEASURED])},
    {", ".join(f"CASE WHEN {m}_val IS NULL THEN 0 ELSE 1 END {m}_forecast_generated"
               for m in D.METRICS)},
    coalesce(warned, 0) warning,
    CASE WHEN coalesce(fails, 0) + dollarsales_flat + transcount_flat + itemcount_flat
      + ingredient_flat + 4 - coalesce(n, 0) > 0 THEN 'Failed' ELSE 'Success' END status
  FROM flat_flags{tag} f LEFT JOIN (SELECT location_num, business_date, {", ".join(
      f"max({n}) FILTER (metric = '{m}') {m}_{n}" for m in D.METRICS for n in _NAMES
  )}, {", ".join(
      f"max({src}) FILTER (metric = '{m}') {m}_{n}"
      for m in D.METRICS for n, src in _MEASURED.items()
  )}, sum(failed) fails, max(warned) warned, count(*) n FROM limit_flags{tag} GROUP BY 1, 2) {_KEY}"""


for _tag in FLAVOURS.values():
    _check_views(_tag)


class DocumentChecks:
    def __init__(self, v: Views, flavour: str = "short"):
        docs = Documents(v, flavour, stored=True)
        metrics = docs.metrics.unionByName(docs.deferred_metrics)
        items = docs.items.unionByName(docs.deferred_items)
        parts = (metrics, items, docs.ingredients, _ITEM, _INGREDIENT)
        self.documents = docs
        self.flats = D.document_flat_flags(docs.header, *parts)
        self.limits = D.limit_flags(D.document_totals(*parts), all_limits(v))
        self.alerts = D.alert_rows(self.flats, self.limits)


_VALUES = [f"{m}_{n}" for m in D.METRICS for n in _MEASURED]


def _limits(v: Views, flavour: str) -> DataFrame:
    return DocumentChecks(v, flavour).limits.withColumns(
        {
            "total": F.round("total", 4),
            "min_limit": F.round("min_limit", 8),
            "max_limit": F.round("max_limit", 8),
        }
    )


def _alerts(v: Views, flavour: str) -> DataFrame:
    return DocumentChecks(v, flavour).alerts.withColumns({c: F.round(c, 8) for c in _VALUES})


def _status(v: Views, flavour: str) -> DataFrame:
    return DocumentChecks(v, flavour).alerts.select(LOC, DAY, "status", "warning")


for _flavour, _tag in FLAVOURS.items():
    for _check, _sql, _fn in (
        (
            "q11_flat_flags",
            "SELECT * FROM flat_flags{tag}",
            lambda v, flavour: DocumentChecks(v, flavour).flats,
        ),
        (
            "q12_limit_flags",
            "SELECT * REPLACE (round(total, 4) AS total, round(min_limit, 8) AS min_limit, "
            "round(max_limit, 8) AS max_limit) FROM limit_flags{tag}",
            _limits,
        ),
        (
            "q13_document_status",
            "SELECT location_num, business_date, status, warning FROM alerts{tag}",
            _status,
        ),
        (
            "q13_alert_rows",
            f"SELECT * REPLACE ({', '.join(f'round({c}, 8) AS {c}' for c in _VALUES)}) "
            "FROM alerts{tag}",
            _alerts,
        ),
    ):
        query(f"{_check}{_tag}", _sql.replace("{tag}", _tag))(
            lambda v, fn=_fn, flavour=_flavour: fn(v, flavour)
        )


def _summary_sql(flags: dict[str, str], alerts: str = "alerts") -> str:
    return (
        "SELECT business_date, "
        + ", ".join(
            f"CAST(count(DISTINCT location_num) FILTER ({c}) AS BIGINT) {n}"
            for n, c in flags.items()
        )
        + f" FROM {alerts} GROUP BY 1"
    )


_FLAGS = {
    "flat": {m: f"{m}_flat = 1" for m in D.METRICS},
    "zero": {m: f"{m}_generated_successfully = 0" for m in D.METRICS},
    "limits": {
        f"{m}_{side}": f"{m}_{flag} = 1"
        for m in D.METRICS
        for side, flag in (("over", "greater_than_15_max"), ("under", "less_than_90_min"))
    },
}
for _kind, _flags in _FLAGS.items():
    V[f"summary_{_kind}"] = _summary_sql(_flags)
    query(f"a06_flag_counts_{_kind}", f"SELECT * FROM summary_{_kind}")(
        lambda v, kind=_kind: D.alert_summary(DocumentChecks(v).alerts, kind)
    )


@query(
    "q14_alert_summary",
    "SELECT * FROM summary_limits WHERE "
    + " OR ".join(f"{n} / 25e0 * 100 > 2.0" for n in _FLAGS["limits"]),
)
def _(v):
    return D.reported(D.alert_summary(DocumentChecks(v).alerts, "limits"), 25)


V["summary_zero_fallback"] = _summary_sql(_FLAGS["zero"], "alerts_fallback")


@query(
    "q14_zero_summary",
    "SELECT * FROM summary_zero_fallback WHERE "
    + " OR ".join(f"{n} <> 0" for n in _FLAGS["zero"]),
)
def _(v):
    """Over the fallback documents, which Sundays are among."""
    return D.reported(D.alert_summary(DocumentChecks(v, "fallback").alerts, "zero"))


# -- missing documents -----------------------------------------------------------------

_WEEK: list[date] = horizon_dates(AS_OF, "short") + horizon_dates(AS_OF, "long")
V["expected_documents"] = f"""
  SELECT location_num, {TODAY} + CAST(i AS INTEGER) business_date
  FROM stores, range(16, 25) r(i) WHERE i <> 20 AND isodow({TODAY} + CAST(i AS INTEGER)) <> 7
    AND NOT (isodow({TODAY} + CAST(i AS INTEGER)) = 6
      AND location_num IN (SELECT location_num FROM saturday_off))"""
V["missing_documents"] = f"""SELECT * FROM expected_documents
  ANTI JOIN (SELECT * FROM doc_header UNION ALL SELECT * FROM doc_header_long) {_KEY}"""


def missing(v: Views) -> DataFrame:
    delivered = [Documents(v, horizon, stored=True).header for horizon in ("short", "long")]
    return D.missing_documents(v.stores, _WEEK, delivered[0].unionByName(delivered[1]), v.saturday_off)


query("q15_missing_documents", "SELECT * FROM missing_documents")(missing)


@query(
    "q16_active_only",
    f"""{_PADDED}, business_date FROM missing_documents
    JOIN (SELECT location_num, isodow(business_date) w FROM past_sales_daily
      WHERE business_date >= {TODAY} - 58 GROUP BY 1, 2 HAVING count(*) >= 3)
      USING (location_num) WHERE isodow(business_date) = w""".replace(
        "SELECT lpad(CAST(location_num", "SELECT lpad(CAST(missing_documents.location_num"
    ),
)
def _(v):
    return D.active_only(missing(v), v.past(v.latest_sales_daily), AS_OF)


V["missing_counts"] = (
    "SELECT business_date, count(location_num) missing_count FROM missing_documents GROUP BY 1"
)


@query(
    "q17_above_threshold",
    "SELECT m.* FROM missing_documents m JOIN missing_counts USING (business_date) "
    "WHERE missing_count > 12",
)
def _(v):
    return D.split_by_threshold(missing(v), 12)[0]


@query(
    "q17_below_threshold",
    "SELECT m.* FROM missing_documents m JOIN missing_counts USING (business_date) "
    "WHERE missing_count <= 12",
)
def _(v):
    return D.split_by_threshold(missing(v), 12)[1]


@query("a15_missing_per_date", "SELECT * FROM missing_counts")
def _(v):
    return A.missing_per_date(missing(v))


# -- recipe, reset, locations ------------------------------------------------------------


@query(
    "q18_ingredient_checks",
    f"""SELECT *, greatest(yield_not_unique, recipe_not_unique, intervals_missing, rows_unexpected)
      failed
    FROM (SELECT
      CASE WHEN EXISTS (SELECT 1 FROM {_newest_all("ycf")} GROUP BY location_num, ingredient_id
        HAVING count(*) > 1) THEN 1 ELSE 0 END yield_not_unique,
      CASE WHEN EXISTS (SELECT 1 FROM {_newest_all("recipe_history")}
        GROUP BY pin, ingredient_id, ingredient_quantity, unit_of_measure, generation_date
        HAVING count(*) > 1) THEN 1 ELSE 0 END recipe_not_unique,
      CASE WHEN (SELECT count(DISTINCT interval_start_time)
        FROM {_newest_all("forecast_ingredients_15min_short")}) <> 96 THEN 1 ELSE 0 END
        intervals_missing,
      CASE WHEN EXISTS (SELECT 1 FROM {_newest_all("forecast_ingredients_15min_short")}
        GROUP BY location_num, business_date, ingredient_id HAVING count(*) <> 96)
        THEN 1 ELSE 0 END rows_unexpected)""",
)
def _(v):
    return L.ingredient_checks(v.ycf, v.recipe_history, v.forecast_ingredients_15min("short"))


@query(
    "q19_reset_check",
    """SELECT *, CASE WHEN staging_rows = 0 AND expected_rows = 0 AND recipe_snapshots = 1
      THEN 'Success' ELSE 'Failed' END status
    FROM (SELECT (SELECT count(*) FROM items_15min) staging_rows,
      (SELECT count(*) FROM expected_products) expected_rows,
      (SELECT count(DISTINCT generation_date) FROM recipe) recipe_snapshots)""",
)
def _(v):
    return L.reset_check(v.items_15min, v.expected_products, v.recipe)


def partition_entries(v: Views) -> DataFrame:
    text = F.concat(F.lit("location_num="), F.lpad(F.col(LOC).cast("string"), 5, "0"))
    return v.lines.select(text.alias("entry"))


def known(v: Views) -> DataFrame:
    return v.location_list.where(F.col(LOC) % 4 != 0)


@query(
    "q20_new_locations",
    "SELECT DISTINCT location_num FROM lines WHERE location_num % 4 = 0",
)
def _(v):
    return L.new_locations(partition_entries(v), known(v))


@query(
    "q21_rebuild_locations",
    """SELECT lpad(CAST(location_num AS VARCHAR), 5, '0') store_number, forecast_type
    FROM (SELECT * FROM location_list WHERE location_num % 4 <> 0
      UNION ALL SELECT DISTINCT location_num, 'baseline' FROM lines WHERE location_num % 4 = 0)""",
)
def _(v):
    added = L.new_locations(partition_entries(v), known(v))
    return L.rebuild_locations(known(v), added)["model"]


V["loads"] = """
  SELECT DISTINCT location_num, CAST(date_trunc('week', generation_date) AS DATE) generation_date
  FROM items_daily WHERE location_num % 8 <> 0
    OR generation_date < DATE '2001-10-08' OR generation_date >= DATE '2001-11-05'"""
V["gap_stores"] = """
  SELECT location_num, current_date_loaded, previous_date_loaded
  FROM (SELECT location_num, max(generation_date) current_date_loaded FROM loads
      WHERE generation_date = (SELECT max(generation_date) FROM loads) GROUP BY 1)
  JOIN (SELECT location_num, max(generation_date) previous_date_loaded FROM loads
      WHERE generation_date < (SELECT max(generation_date) FROM loads) GROUP BY 1)
    USING (location_num)
  WHERE current_date_loaded - previous_date_loaded > 15"""


def loads(v: Views) -> DataFrame:
    """Weekly item loads per store; every eighth store paused before the newest one."""
    paused = F.col(GEN).between(F.lit(date(2001, 10, 8)), F.lit(date(2001, 11, 4)))
    return (
        v.items_daily.where((F.col(LOC) % 8 != 0) | ~paused)
        .select(LOC, F.trunc(GEN, "week").alias(GEN))
        .distinct()
    )


@query(
    "q22_runnable_stores",
    f"""{_PADDED} FROM (SELECT DISTINCT location_num FROM reconciled_metrics WHERE dailyqc = 1
      INTERSECT SELECT DISTINCT location_num FROM reconciled_items WHERE dailyqc = 1)
    WHERE location_num IN (SELECT location_num FROM location_list)
      AND location_num IN (SELECT location_num FROM loads
        WHERE generation_date = (SELECT max(generation_date) FROM loads))
      AND location_num NOT IN (SELECT location_num FROM gap_stores)""",
)
def _(v):
    verdicts = [
        L.checked_stores(q.select(LOC, "dailyqc", GEN), v.location_list, loads(v), loads(v))
        for q in (q01(v), q02(v))
    ]
    return L.runnable_stores(*verdicts)


@query("j11_gap_stores", "SELECT * FROM gap_stores")
def _(v):
    from tillcast.operators.snapshot import gap_stores

    return gap_stores(loads(v))

"""Single operators (P, J, A, W, O, U and F rows) beside their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.forecasts import _latest, all_limits, control, input_items, k01, k19
from catalog.registry import query
from catalog.views import AS_OF, DAY, GEN, LOC, Views, days
from catalog.views_sql import AS_OF as TODAY
from catalog.views_sql import VIEWS_SQL as V
from catalog.views_sql import closed_holiday, dec2, last_year
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
from tillcast.operators.segments import exact_quantiles
from tillcast.plans import limits as L

_IN_SAT_OFF = "location_num IN (SELECT location_num FROM saturday_off)"
_CLOSED = f"(isodow(business_date) = 7 OR (isodow(business_date) = 6 AND {_IN_SAT_OFF}))"


def _sum_decimal(measure: str) -> str:
    return f"CAST(sum({measure}) AS DECIMAL(18,2))"


def _round(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# -- P: projections and filters ----------------------------------------------------

query(
    "p01_latest_snapshot",
    "SELECT * FROM recipe_history WHERE generation_date = "
    "(SELECT max(generation_date) FROM recipe_history)",
)(lambda v: S.latest_snapshot(v.recipe_history))
query("p02_latest_snapshot_per_store", f"SELECT * FROM {_latest('sales_15min')}")(
    lambda v: S.latest_snapshot(
        v.sales_15min, keys=[LOC], control=v.versions("sales_15min", v.sales_15min)
    )
)


@query(
    "p02_newest_versions",
    "SELECT location_num, max(generation_date) generation_date FROM sales_15min GROUP BY 1",
)
def _(v):
    """The control table kept from load to load: three by version, the second one twice."""
    loads = v.sales_15min.select(LOC, GEN)
    a, b = F.lit(days(-2000)), F.lit(days(-1200))
    parts = [loads.where(F.col(GEN) < a), loads.where(F.col(GEN).between(a, b)), loads.where(F.col(GEN) > b)]
    control = None
    for part in (parts[1], parts[0], parts[1], parts[2]):
        control = S.newest_versions(part, [LOC], control=control)
    return control


query(
    "p03_latest_snapshot_per_store_date",
    f"SELECT * FROM {_latest('items_daily', 'location_num, business_date')}",
)(
    lambda v: S.latest_snapshot(
        v.items_daily, keys=[LOC, DAY], control=v.versions("items_daily", v.items_daily, LOC, DAY)
    )
)
query(
    "p04_latest_version_per_key",
    """SELECT DISTINCT location_num, timequarter, flag, price, generation_date FROM (
      SELECT * FROM lines QUALIFY generation_date
        = max(generation_date) OVER (PARTITION BY location_num, timequarter))""",
)(lambda v: S.dedupe_latest(v.lines, [LOC, "timequarter"], ["flag", "price"]))
query(
    "p05_mask_closed",
    f"""SELECT location_num, business_date, item_id, generation_date,
      CASE WHEN {_CLOSED} THEN 0e0 ELSE forecast END forecast FROM forecast_items_long""",
)(lambda v: P.mask_closed(v.forecast_items("long"), v.saturday_off, ["forecast"]))
query(
    "p06_closed_flag",
    f"""SELECT location_num, business_date, dayofweek,
      CASE WHEN {_IN_SAT_OFF} AND dayofweek IN (6, 7) THEN 1 ELSE sunday END sunday
    FROM latest_sales_daily JOIN calendar_daily USING (business_date)""",
)(
    lambda v: P.closed_flag(
        v.latest_sales_daily.select(LOC, DAY).join(
            v.calendar_daily.select(DAY, "dayofweek", "sunday"), DAY
        ),
        v.saturday_off,
    )
)


def _bounds(final: str, initial: str) -> str:
    return (
        f"(SELECT location_num, max(business_date) AS a FROM {final} GROUP BY 1) "
        f"JOIN (SELECT location_num, max(business_date) AS b FROM {initial} GROUP BY 1) "
        "USING (location_num)"
    )


query(
    "p07_incremental_slice",
    f"""SELECT location_num, business_date, dayofweek
    FROM {_bounds("prepared_sales_daily", "sales_daily")}
    JOIN calendar_daily ON business_date > a AND business_date <= b""",
)(
    lambda v: S.incremental_slice(
        v.calendar_daily.select(DAY, "dayofweek"),
        S.incremental_bounds(v.prepared(v.latest_sales_daily), v.sales_daily),
    )
)
query(
    "p08_incremental_slice_default",
    """SELECT location_num, business_date, dayofweek
    FROM (SELECT location_num, max(business_date) AS b FROM sales_daily GROUP BY 1)
    LEFT JOIN (SELECT location_num, max(business_date) AS a FROM prepared_sales_daily
      WHERE location_num % 2 = 0 GROUP BY 1) USING (location_num)
    JOIN calendar_daily ON business_date > coalesce(a, DATE '2001-10-01') AND business_date <= b""",
)(
    lambda v: S.incremental_slice(
        v.calendar_daily.select(DAY, "dayofweek"),
        S.incremental_bounds(
            v.prepared(v.latest_sales_daily).where(F.col(LOC) % 2 == 0),
            v.sales_daily,
            default=date(2001, 10, 1),
        ),
    )
)
query(
    "p09_regular_days",
    """SELECT location_num, business_date, sales_sub_total, generation_date FROM sales_daily
    WHERE isodow(business_date) <> 7 AND business_date NOT IN (SELECT business_date
      FROM calendar_daily WHERE federalholiday_name <> 'Regular-day' OR holiday = 1)""",
)(
    lambda v: P.regular_days(v.sales_daily, v.calendar_daily).select(
        LOC, DAY, "sales_sub_total", GEN
    )
)
query("p10_operable_dates", "SELECT * FROM operable")(
    lambda v: P.operable_dates(
        v.stores,
        C.horizon_dates(AS_OF, "short") + C.horizon_dates(AS_OF, "long"),
        v.saturday_off,
    )
)


def _measures(v: Views) -> DataFrame:
    return v.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_discount",
        F.when(F.col("l_linenumber") != 1, F.col("l_tax")).alias("tax"),
    )


query(
    "p11_drop_all_zero",
    """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_discount,
      CASE WHEN l_linenumber <> 1 THEN l_tax END tax FROM lineitem)
    WHERE CASE WHEN l_discount IN (0, NULL) AND tax IN (0, NULL) THEN 0 ELSE 1 END = 1""",
)(lambda v: P.drop_all_zero(_measures(v), ["l_discount", "tax"]))
V["statuses"] = f"""
  SELECT *, CASE WHEN status = 0 THEN closing ELSE DATE '1901-01-01' END period FROM (
    SELECT *, CASE
      WHEN (remodelclosedate = no AND remodelprojectedclosedate = no) OR closing > {TODAY}
        OR opening < {TODAY} - 25
        OR (remodelclosedate IS NOT NULL AND remodelprojectedclosedate = no) THEN 1
      WHEN closing <= {TODAY} AND {TODAY} < opening - 20 THEN 99
      WHEN opening >= {TODAY} - 45 THEN 0 ELSE 9999 END status
    FROM (SELECT *, DATE '1901-01-01' AS no,
      CASE WHEN remodelclosedate = DATE '1901-01-01' THEN remodelprojectedclosedate
        ELSE remodelclosedate END closing,
      CASE WHEN remodelreopendate = DATE '1901-01-01' THEN remodelprojectedreopendate
        ELSE remodelreopendate END opening FROM locations))"""
query("p12_store_status", "SELECT location_num, status, period FROM statuses")(
    lambda v: P.store_status(v.locations, AS_OF).select(LOC, "status", "period")
)
query(
    "p13_forecastable",
    """SELECT * FROM (SELECT lpad(CAST(location_num AS VARCHAR), 5, '0') store_number,
      CASE WHEN status = 99 AND remodelclosedate = DATE '1901-01-01' THEN 1 ELSE status END status,
      period FROM statuses
      WHERE location_num IN (SELECT location_num FROM location_list WHERE forecast_type = 'LSTM'))
    WHERE status <= 1""",
)(lambda v: P.forecastable(P.store_status(v.locations, AS_OF), v.location_list, 1))
query(
    "p14_parse_settings",
    "SELECT DISTINCT location_num, lookup_weeks, smoothing_fact FROM control",
)(lambda v: P.parse_settings(v.stores, v.settings))
query(
    "p15_split_horizons",
    f"""SELECT location_num, business_date, forecast,
      CASE WHEN business_date - {TODAY} <= 19 THEN 'short' WHEN business_date - {TODAY} <= 24
        THEN 'long' ELSE 'redundancy' END horizon
    FROM (SELECT location_num, business_date + 364 business_date, sales_sub_total forecast
      FROM latest_sales_daily)
    WHERE business_date - {TODAY} BETWEEN 16 AND 29 AND business_date - {TODAY} <> 20""",
)(
    lambda v: P.split_horizons(
        v.latest_sales_daily.select(
            LOC, F.date_add(DAY, 364).alias(DAY), F.col("sales_sub_total").alias("forecast")
        ),
        AS_OF,
    )
)
query(
    "p16_clamp",
    """SELECT location_num, business_date,
      CASE WHEN sales_sub_total - 30000 < 0 THEN 0 ELSE sales_sub_total - 30000 END forecast
    FROM latest_sales_daily""",
)(
    lambda v: P.clamp_columns(
        v.latest_sales_daily.select(
            LOC, DAY, (F.col("sales_sub_total") - 30000).cast("decimal(19,2)").alias("forecast")
        ),
        ["forecast"],
    ).withColumn("forecast", N.dec2(F.col("forecast")))
)
query(
    "p17_zero_fill",
    """SELECT location_num, business_date, coalesce(s.sales_sub_total, 0) sales_sub_total
    FROM stores JOIN calendar_daily ON business_date BETWEEN DATE '2001-05-01' AND DATE '2001-06-30'
    LEFT JOIN latest_sales_daily s USING (location_num, business_date)""",
)(
    lambda v: P.zero_fill(
        J.scaffold(v.stores, [days(-n) for n in range(1, 62)]).join(
            v.latest_sales_daily.select(LOC, DAY, "sales_sub_total"), [LOC, DAY], "left"
        ),
        ["sales_sub_total"],
    )
)
query(
    "p18_to_contract",
    """SELECT CAST(location_num AS VARCHAR) "StoreNumber", business_date "BusinessDay",
      CAST(sales_sub_total AS VARCHAR) "Sales", CAST(trans_count AS VARCHAR) "TransactionCount"
    FROM latest_sales_daily""",
)(
    lambda v: P.contract_projection(
        v.latest_sales_daily,
        {
            "StoreNumber": LOC,
            "BusinessDay": DAY,
            "Sales": "sales_sub_total",
            "TransactionCount": "trans_count",
        },
        ["StoreNumber", "Sales", "TransactionCount"],
    )
)
query(
    "p19_holidays",
    "SELECT business_date FROM calendar_daily WHERE holiday = 1 AND year(business_date) = 2001",
)(lambda v: P.holidays(v.calendar_daily, AS_OF))
query(
    "p20_min_history",
    """SELECT location_num, product, business_date, sum_daily_quantity FROM latest_items_daily
    QUALIFY count(*) OVER (PARTITION BY location_num, product) >= 57""",
)(
    lambda v: P.min_history(
        v.latest_items_daily.select(LOC, "product", DAY, "sum_daily_quantity"), [LOC, "product"]
    )
)
query(
    "p21_freshness",
    f"""SELECT location_num, product, max(business_date) - 31 first_forecast_date,
      CASE WHEN {TODAY} - (max(business_date) - 31) > 6 THEN 1 ELSE 0 END forecast_zero
    FROM latest_items_daily GROUP BY 1, 2""",
)(lambda v: P.freshness(v.latest_items_daily, [LOC, "product"], AS_OF))

# -- J: joins ------------------------------------------------------------------------

query(
    "j01_inner_join",
    """SELECT r.location_num, r.business_date, r.time, r.product, r.ratio, f.forecast
    FROM item_ratios r JOIN forecast_items_short f ON f.location_num = r.location_num
      AND f.business_date = r.business_date AND f.item_id = r.product""",
)(
    lambda v: v.item_ratios()
    .drop(GEN)
    .join(
        v.forecast_items("short").select(
            LOC, DAY, F.col("item_id").alias("product"), "forecast"
        ),
        [LOC, DAY, "product"],
    )
)
query(
    "j02_padding_join",
    """SELECT location_num, product, business_date,
      coalesce(sum_daily_quantity, 0) sum_daily_quantity
    FROM (SELECT DISTINCT location_num, product FROM items_daily)
    CROSS JOIN (SELECT DATE '2001-06-01' + CAST(i AS INTEGER) business_date FROM range(30) r(i))
    LEFT JOIN latest_items_daily USING (location_num, product, business_date)""",
)(
    lambda v: J.pad(
        J.scaffold(
            v.items_daily.select(LOC, "product").distinct(), [days(-n) for n in range(1, 31)]
        ),
        v.latest_items_daily,
        [LOC, "product", DAY],
        ["sum_daily_quantity"],
    )
)
query(
    "j03_right_join",
    """SELECT business_date, location_num, sales_sub_total FROM latest_sales_daily
    RIGHT JOIN (SELECT business_date FROM calendar_daily) USING (business_date)""",
)(
    lambda v: v.latest_sales_daily.select(DAY, LOC, "sales_sub_total").join(
        v.calendar_daily.select(DAY), DAY, "right"
    )
)
query(
    "j04_full_join",
    """SELECT location_num, business_date, s.forecast sales, t.sales_sub_total actual
    FROM (SELECT DISTINCT location_num, business_date, forecast FROM forecast_sales_short) s
    LEFT JOIN latest_sales_daily t USING (location_num, business_date)
    UNION SELECT location_num, business_date, s.forecast, t.sales_sub_total
    FROM forecast_sales_short s RIGHT JOIN latest_sales_daily t
      USING (location_num, business_date)""",
)(
    lambda v: J.full_join(
        v.forecast_sales("short").select(LOC, DAY, F.col("forecast").alias("sales")),
        v.latest_sales_daily.select(LOC, DAY, F.col("sales_sub_total").alias("actual")),
        [LOC, DAY],
    )
)
query(
    "j05_scaffold",
    """SELECT location_num, product, business_date, "interval"
    FROM (SELECT DISTINCT location_num, product FROM items_daily),
      (SELECT unnest([DATE '2001-07-17', DATE '2001-07-18']) business_date), time_grid""",
)(
    lambda v: J.scaffold(
        v.items_daily.select(LOC, "product").distinct(),
        C.horizon_dates(AS_OF, "short")[:2],
        intervals=True,
    )
)
query(
    "j06_range_join",
    """SELECT c.location_num, c.prediction_date, c.lookup_weeks, h.business_date,
      h.sales_sub_total
    FROM latest_sales_daily h RIGHT JOIN control c ON h.location_num = c.location_num
      AND isodow(h.business_date) = isodow(c.prediction_date)
      AND h.business_date >= c.prediction_date - 364 - 7 * c.lookup_weeks
      AND h.business_date < c.prediction_date - 364""",
)(
    lambda v: J.range_lookback_join(
        v.latest_sales_daily.select(LOC, DAY, "sales_sub_total"),
        control(v)
        .withColumn("ly_fiscal_date", C.fiscal_last_year(F.col("prediction_date")))
        .withColumn("ly_min_date", F.expr("date_sub(ly_fiscal_date, 7 * lookup_weeks)")),
    ).select(LOC, "prediction_date", "lookup_weeks", DAY, "sales_sub_total")
)
query(
    "j07_anti_join",
    """SELECT DISTINCT location_num, item_id FROM forecast_items_short f WHERE NOT EXISTS (
      SELECT 1 FROM item_ratios r WHERE r.location_num = f.location_num AND r.product = f.item_id)""",
)(
    lambda v: J.without(
        v.forecast_items("short").select(LOC, "item_id").distinct(),
        v.item_ratios().withColumnRenamed("product", "item_id"),
        [LOC, "item_id"],
    )
)


def _dates_of(v: Views, nulls: bool) -> DataFrame:
    day = F.when(F.col("holiday") == 1, F.col(DAY)) if nulls else F.col(DAY)
    rows = v.calendar_daily if nulls else v.calendar_daily.where("federalholiday = 1")
    return rows.select(day.alias(DAY))


query(
    "j08_not_in",
    """SELECT location_num, business_date, sales_sub_total FROM latest_sales_daily
    WHERE business_date NOT IN (SELECT business_date FROM calendar_daily
      WHERE federalholiday = 1)""",
)(
    lambda v: J.not_in(
        v.latest_sales_daily.select(LOC, DAY, "sales_sub_total"), DAY, _dates_of(v, False)
    )
)
query(
    "j08_not_in_with_null",
    """SELECT location_num, business_date, sales_sub_total FROM latest_sales_daily
    WHERE business_date NOT IN (SELECT CASE WHEN holiday = 1 THEN business_date END
      FROM calendar_daily)""",
)(
    lambda v: J.not_in(
        v.latest_sales_daily.select(LOC, DAY, "sales_sub_total"), DAY, _dates_of(v, True)
    )
)
query(
    "j09_semi_join",
    "SELECT * FROM latest_sales_daily WHERE location_num IN "
    "(SELECT location_num FROM location_list WHERE forecast_type = 'LSTM')",
)(
    lambda v: v.latest_sales_daily.join(
        v.location_list.where("forecast_type = 'LSTM'"), LOC, "left_semi"
    ).select(v.latest_sales_daily.columns)
)
query(
    "j10_date_bound_check",
    f"""SELECT location_num, coalesce(low <> run_date + 16, false)
      OR coalesce(high <> run_date + 19, false) wrong_dates
    FROM (SELECT location_num, min(business_date) low, max(business_date) high
      FROM {_latest("forecast_items_short")} n GROUP BY 1)
    LEFT JOIN (SELECT location_num, max(generation_date) run_date FROM forecast_sales_short
      GROUP BY 1) USING (location_num)""",
)(
    lambda v: J.date_bound_check(
        S.latest_snapshot(v.forecast_items("short"), keys=[LOC]),
        v.forecast_sales("short").groupBy(LOC).agg(F.max(GEN).alias("run_date")),
        16,
        19,
    )
)
query(
    "j12_side_by_side",
    f"""SELECT * FROM (SELECT location_num, {_sum_decimal("sales_sub_total")} initial_total
      FROM sales_daily GROUP BY 1)
    JOIN (SELECT location_num, {_sum_decimal("sales_sub_total")} final_total
      FROM latest_sales_daily GROUP BY 1) USING (location_num)
    JOIN (SELECT location_num, {_sum_decimal("sales_sub_total")} interval_total
      FROM sales_15min GROUP BY 1) USING (location_num)""",
)(
    lambda v: J.side_by_side(
        [
            df.groupBy(LOC).agg(N.dsum(F.col("sales_sub_total"), False).alias(name))
            for name, df in (
                ("initial_total", v.sales_daily),
                ("final_total", v.latest_sales_daily),
                ("interval_total", v.sales_15min),
            )
        ]
    )
)
query(
    "j13_explode_recipe",
    """SELECT i.location_num, i.product, i.business_date, i.sum_daily_quantity, r.ingredient_id,
      r.ingredient_quantity, r.unit_of_measure, round(coalesce(y.ycf, 1e0), 6) ycf
    FROM latest_items_daily i JOIN recipe r ON r.pin = i.product
    LEFT JOIN (SELECT location_num, ingredient_id, avg(ycf) ycf FROM ycf GROUP BY 1, 2) y
      ON y.location_num = i.location_num AND y.ingredient_id = r.ingredient_id""",
)(
    lambda v: _round(
        J.explode_recipe(v.latest_items_daily.drop(GEN), v.recipe, J.mean_yield(v.ycf)), "ycf"
    )
)
query(
    "j14_time_of_day_join",
    f"""SELECT f.location_num, f.business_date, strftime(f.timequarter, '%H:%M:%S') AS time,
      f.sales_sub_total, q.sales_sub_total lastyearsales
    FROM latest_sales_15min f JOIN latest_sales_15min q ON q.location_num = f.location_num
      AND q.business_date = {last_year("f.business_date")}
      AND strftime(q.timequarter, '%H:%M:%S') = strftime(f.timequarter, '%H:%M:%S')""",
)(lambda v: _with_last_year(v))
query(
    "j15_padded_join",
    """SELECT lpad(CAST(location_num AS VARCHAR), 5, '0') store_number, forecast_type
    FROM (SELECT DISTINCT location_num FROM sales_daily) JOIN location_list USING (location_num)""",
)(
    lambda v: J.padded_join(
        v.sales_daily.select(T.pad_store(F.col(LOC)).alias("store_number")).distinct(),
        v.location_list,
    )
)

# -- A: aggregates -------------------------------------------------------------------

_PRICE = "l_extendedprice * (1 - l_discount)"
query(
    "a01_decimal_sums",
    f"""SELECT s_nationkey, CAST(sum({dec2(_PRICE)}) AS DECIMAL(18,2)) cast_first,
      CAST(round(sum(CAST(CAST({_PRICE} AS VARCHAR) AS DECIMAL(18,9))), 2) AS DECIMAL(18,2))
        cast_last
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""",
)(
    lambda v: v.table("lineitem")
    .join(v.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    .groupBy("s_nationkey")
    .agg(
        N.dsum(F.expr(_PRICE), True).alias("cast_first"),
        N.dsum(F.expr(_PRICE).cast("decimal(18,9)"), False).alias("cast_last"),
    )
)
query(
    "a02_average_with_default",
    """SELECT location_num, ingredient_id, round(coalesce(avg(CASE WHEN ycf < 1.2 THEN ycf END),
      1e0), 6) ycf FROM ycf GROUP BY 1, 2""",
)(
    lambda v: _round(
        v.ycf.groupBy(LOC, "ingredient_id").agg(
            N.avg_or(F.when(F.col("ycf") < 1.2, F.col("ycf")), 1.0).alias("ycf")
        ),
        "ycf",
    )
)
query(
    "a03_sum_over_expected_count",
    """SELECT location_num, prediction_date, round(CASE WHEN forecast_avg_dr > 0
      THEN CAST(sum(sales_sub_total) AS DOUBLE) / forecast_avg_dr ELSE 0 END, 6) average
    FROM baseline_dates JOIN latest_sales_daily USING (location_num, business_date)
    GROUP BY location_num, prediction_date, forecast_avg_dr""",
)(
    lambda v: _round(
        k01(v)
        .drop(GEN)
        .join(v.latest_sales_daily.select(LOC, DAY, "sales_sub_total"), [LOC, DAY])
        .groupBy(LOC, "prediction_date", "forecast_avg_dr")
        .agg(
            N.planned_mean(F.col("sales_sub_total"), F.first("forecast_avg_dr")).alias("average")
        )
        .drop("forecast_avg_dr"),
        "average",
    )
)
query(
    "a04_list_aggregation",
    """SELECT location_num, prediction_date,
      string_agg(CAST(business_date AS VARCHAR), ',' ORDER BY business_date) dates,
      string_agg(CAST(sales_sub_total AS VARCHAR), ',' ORDER BY business_date) metric_list,
      CAST(sum(sales_sub_total) AS DECIMAL(18,2)) total
    FROM baseline_dates JOIN latest_sales_daily USING (location_num, business_date)
    GROUP BY 1, 2""",
)(
    lambda v: A.value_lists(
        k01(v)
        .drop(GEN)
        .join(v.latest_sales_daily.select(LOC, DAY, "sales_sub_total"), [LOC, DAY]),
        [LOC, "prediction_date"],
        "sales_sub_total",
        DAY,
    ).select(
        LOC,
        "prediction_date",
        F.concat_ws(",", F.col("dates_list").cast("array<string>")).alias("dates"),
        F.concat_ws(",", F.col("metric_values").cast("array<string>")).alias("metric_list"),
        N.dec2(F.col("sum_sales_sub_total")).alias("total"),
    )
)
query(
    "a05_coverage",
    "SELECT location_num, business_date, count(*) row_count, count(DISTINCT product) item_count "
    "FROM items_15min GROUP BY 1, 2",
)(lambda v: A.coverage(v.items_15min, [LOC, DAY], "product"))
query(
    "a07_weekday_stats",
    f"""SELECT location_num, weekday, min(x) min_value, max(x) max_value, round(avg(x), 6) mean,
      round(median(x), 6) median, round(stddev_samp(x), 4) std,
      round(quantile_cont(x, 0.75) - quantile_cont(x, 0.25), 6) iqr
    FROM (SELECT location_num, CAST(isodow(business_date) - 1 AS INTEGER) weekday,
      CAST(sales_sub_total AS DOUBLE) x FROM latest_sales_daily) GROUP BY 1, 2""",
)(
    lambda v: _round(
        _round(
            A.weekday_stats(
                v.latest_sales_daily.select(
                    LOC,
                    F.weekday(DAY).alias("weekday"),
                    F.col("sales_sub_total").alias("demand"),
                )
            ),
            "mean",
            "median",
            "iqr",
        ),
        "std",
        digits=4,
    )
)
query(
    "a08_repair_medians",
    """SELECT location_num, weekday, round(median, 6) median FROM limits_transcount""",
)(
    lambda v: _round(
        A.repair_medians(
            A.weekday_stats(
                L.daily_demand(v.sales_daily, v.calendar_daily, "trans_count", 35), bounded=True
            )
        ).select(LOC, "weekday", "median"),
        "median",
    )
)
query(
    "a09_frequent_weekdays",
    f"""SELECT location_num, weekday, CAST(sum(cnt) AS BIGINT) cnt FROM (
      SELECT location_num, CAST(isodow(business_date) - 1 AS INTEGER) weekday, count(*) cnt
      FROM sales_daily WHERE business_date >= {TODAY} - 58 GROUP BY location_num, business_date)
    GROUP BY 1, 2 HAVING sum(cnt) >= 3""",
)(lambda v: A.frequent_weekdays(v.sales_daily, F.lit(days(-58))))
query(
    "a10_rollup_daily",
    f"""SELECT location_num, business_date, {_sum_decimal("sales_sub_total")} sales_sub_total,
      {_sum_decimal("trans_count")} trans_count FROM sales_15min GROUP BY 1, 2""",
)(
    lambda v: A.rollup_daily(
        v.sales_15min, ["sales_sub_total", "trans_count"], [LOC, DAY]
    ).withColumns({m: N.dec2(F.col(m)) for m in ("sales_sub_total", "trans_count")})
)
query(
    "a11_all_passed",
    "SELECT location_num, min(dailyqc) forecast_qc FROM metric_checks GROUP BY 1",
)(lambda v: A.all_passed(v.metric_checks.withColumnRenamed("dailyqc", "forecast_qc")))
query(
    "a12_weekday_quantiles",
    """SELECT location_num, product, dayofweek, round(quantile_cont(x, 0.25), 6) q1,
      round(quantile_cont(x, 0.75), 6) q3, round(median(x), 6) median
    FROM heads WHERE head AND regular GROUP BY 1, 2, 3""",
)(
    lambda v: _round(
        A.weekday_quantiles(
            P.regular_history(
                P.first_rows(input_items(v), [LOC, "product"]), v.saturday_off
            ).where("_head and _regular"),
            [LOC, "product"],
            "sum_daily_quantity",
        ),
        "q1",
        "q3",
        "median",
    )
)
query(
    "a13_distinct_days",
    "SELECT location_num, prediction_date, lookup_weeks, forecast_avg_dr, "
    "count(DISTINCT business_date) row_count FROM baseline_dates GROUP BY 1, 2, 3, 4",
)(lambda v: A.distinct_days(k01(v)))
query(
    "a14_date_bounds",
    """SELECT location_num, min(prediction_date - 364 - 7 * lookup_weeks) min_date,
      max(prediction_date - 364) max_date FROM control WHERE smoothing_fact <> 0 GROUP BY 1""",
)(
    lambda v: A.date_bounds(
        control(v)
        .where("smoothing_fact != 0")
        .withColumn("high", F.date_sub("prediction_date", 364))
        .withColumn("low", F.expr("date_sub(high, 7 * lookup_weeks)")),
        "low",
        "high",
    )
)
query(
    "a16_products_per_store",
    "SELECT location_num, count(DISTINCT product) products FROM items_15min GROUP BY 1",
)(lambda v: A.products_per_store(v.items_15min))
query(
    "a17_newest_load",
    """SELECT max(business_date) business_date, max(generation_date) generation_date
    FROM sales_daily WHERE generation_date = (SELECT max(generation_date) FROM sales_daily)""",
)(lambda v: S.newest_load(v.sales_daily))

# -- W: windows ----------------------------------------------------------------------

query(
    "w01_partition_max",
    "SELECT location_num, business_date, max(generation_date) newest FROM sales_daily GROUP BY 1, 2",
)(lambda v: v.sales_daily.groupBy(LOC, DAY).agg(F.max(GEN).alias("newest")))
V["matched_days"] = """
  SELECT * FROM (SELECT c.location_num, c.prediction_date, c.lookup_weeks, h.business_date,
      h.sales_sub_total
    FROM control c JOIN past_sales_daily h ON h.location_num = c.location_num
      AND isodow(h.business_date) = isodow(c.prediction_date))
  QUALIFY rank() OVER (PARTITION BY location_num, prediction_date
    ORDER BY business_date DESC) < lookup_weeks"""
_PAIR = [LOC, "prediction_date"]


def _matched(v: Views) -> DataFrame:
    history = v.past(v.latest_sales_daily).select(
        LOC, DAY, "sales_sub_total", F.weekday(DAY).alias("_dow")
    )
    wanted = control(v).withColumn("_dow", F.weekday("prediction_date"))
    return W.recent_same_weekday(
        wanted.join(history, [LOC, "_dow"]).select(
            *_PAIR, "lookup_weeks", DAY, "sales_sub_total"
        ),
        _PAIR,
    )


V["trimmed_days"] = """
  SELECT * FROM matched_days
  QUALIFY sales_sub_total <> min(sales_sub_total) OVER (PARTITION BY location_num, prediction_date)
    AND sales_sub_total <> max(sales_sub_total) OVER (PARTITION BY location_num, prediction_date)"""


def _trimmed(v: Views) -> DataFrame:
    return W.trim_extremes(_matched(v), _PAIR, "sales_sub_total")


query("w02_recent_same_weekday", "SELECT * FROM matched_days")(_matched)
query("w03_trim_extremes", "SELECT * FROM trimmed_days")(_trimmed)
query(
    "w04_survivors",
    "SELECT *, count(business_date) OVER (PARTITION BY location_num, prediction_date) survivors "
    "FROM trimmed_days",
)(lambda v: W.with_survivors(_trimmed(v), _PAIR, "survivors"))
query(
    "w05_partition_lists",
    """SELECT location_num, prediction_date, business_date, dates FROM matched_days JOIN (
      SELECT location_num, prediction_date,
        string_agg(CAST(business_date AS VARCHAR), ',' ORDER BY business_date) dates
      FROM matched_days GROUP BY 1, 2) USING (location_num, prediction_date)""",
)(
    lambda v: W.with_partition_lists(_matched(v), _PAIR, {"dates": DAY}).select(
        *_PAIR, DAY, F.concat_ws(",", F.col("dates").cast("array<string>")).alias("dates")
    )
)
query(
    "w06_first_rows",
    "SELECT location_num, product, business_date FROM heads WHERE head",
)(
    lambda v: P.first_rows(input_items(v), [LOC, "product"])
    .where("_head")
    .select(LOC, "product", DAY)
)
query(
    "w07_supervised_frame",
    """SELECT * FROM (SELECT location_num, product, business_date,
      lag(x, 2) OVER w quantity_m2, lag(dayofweek, 2) OVER w dayofweek_m2,
      lag(x, 1) OVER w quantity_m1, lag(dayofweek, 1) OVER w dayofweek_m1,
      x quantity_t, dayofweek dayofweek_t,
      lead(x, 1) OVER w quantity_p1, lead(dayofweek, 1) OVER w dayofweek_p1
      FROM zero_imputed WINDOW w AS (PARTITION BY location_num, product ORDER BY business_date))
    WHERE quantity_m2 IS NOT NULL AND quantity_p1 IS NOT NULL""",
)(
    lambda v: W.supervised_frame(
        k19(v).withColumnRenamed("sum_daily_quantity", "quantity"),
        [LOC, "product"],
        ["quantity", "dayofweek"],
        2,
        2,
    )
)
query(
    "w08_latest_200",
    """SELECT location_num, business_date, generation_date, sales_sub_total FROM sales_daily
    QUALIFY row_number() OVER (PARTITION BY location_num
      ORDER BY business_date DESC, generation_date DESC) <= 200""",
)(
    lambda v: S.top_n_by(
        v.sales_daily.select(LOC, DAY, GEN, "sales_sub_total"),
        [LOC],
        [F.desc(DAY), F.desc(GEN)],
        200,
    )
)
V["median_series"] = """
  SELECT location_num, 0 n, list(coalesce(x, 0e0) ORDER BY day) series
  FROM (SELECT location_num, CAST(unnest(range(last - INTERVAL 29 DAYS, last + INTERVAL 1 DAY, INTERVAL 1 DAY))
      AS DATE) AS day FROM (SELECT location_num, max(business_date) last FROM past_sales_daily GROUP BY 1))
  LEFT JOIN (SELECT location_num, business_date AS day, CAST(sum(sales_sub_total) AS DOUBLE) x
    FROM past_sales_daily GROUP BY 1, 2) USING (location_num, day)
  GROUP BY 1
  UNION ALL
  SELECT location_num, n + 1, list_append(series, list_median(series[-30:]))
  FROM median_series WHERE n < 34"""


def _recursive(v: Views) -> DataFrame:
    history = trailing_days(v.past(v.latest_sales_daily), [LOC], "sales_sub_total", 30)
    ahead = F.slice(recursive_median(F.col("history")), 31, 34)
    steps = history.select(LOC, F.posexplode(ahead).alias("step", "forecast"))
    return steps.select(LOC, (F.col("step") + 1).alias("step"), F.round("forecast", 6).alias("forecast"))


query(
    "w09_recursive_median",
    """SELECT location_num, CAST(step AS INTEGER) step, round(series[30 + step], 6) forecast
    FROM median_series, (SELECT unnest(range(1, 35)) step) WHERE n = 34""",
)(_recursive)

# -- O and U: order and sets -----------------------------------------------------------

query("o01_global_sort", "SELECT * FROM latest_sales_daily ORDER BY location_num, business_date")(
    lambda v: v.latest_sales_daily.orderBy(LOC, DAY)
)
query(
    "o02_latest_dates",
    """SELECT DISTINCT location_num, business_date FROM (SELECT * FROM sales_15min
    QUALIFY dense_rank() OVER (PARTITION BY location_num ORDER BY business_date DESC) <= 56)""",
)(lambda v: S.latest_dates(v.sales_15min, 56))
query(
    "u01_union_all",
    "SELECT * FROM forecast_sales_short UNION ALL SELECT * FROM forecast_sales_long "
    "UNION ALL SELECT * FROM forecast_sales_redundancy",
)(lambda v: U.union_all(*[v.forecast_sales(h) for h in C.HORIZONS]))
query(
    "u02_union_distinct",
    """SELECT location_num, business_date FROM forecast_sales_short
    UNION SELECT location_num, business_date FROM forecast_trans_short""",
)(
    lambda v: U.union_distinct(
        v.forecast_sales("short").select(LOC, DAY), v.forecast_trans("short").select(LOC, DAY)
    )
)
query(
    "u03_key_difference",
    "SELECT location_num, product FROM items_daily EXCEPT SELECT location_num, product "
    "FROM combinations",
)(lambda v: U.key_difference(v.items_daily, v.combinations, [LOC, "product"]))
query(
    "u04_key_intersection",
    """SELECT location_num FROM metric_checks WHERE dailyqc = 0
    INTERSECT SELECT location_num FROM item_checks WHERE dailyqc = 0""",
)(
    lambda v: U.key_intersection(
        v.metric_checks.where("dailyqc = 0"), v.item_checks.where("dailyqc = 0"), [LOC]
    )
)
query("u05_distinct", "SELECT DISTINCT location_num, product, flag FROM lines")(
    lambda v: v.lines.select(LOC, "product", "flag").distinct()
)

# -- F: functions ----------------------------------------------------------------------

query(
    "f01_pad_store",
    """SELECT DISTINCT l_partkey, CASE WHEN length(CAST(l_partkey * 37 AS VARCHAR)) < 5
      THEN lpad(CAST(l_partkey * 37 AS VARCHAR), 5, '0') ELSE CAST(l_partkey * 37 AS VARCHAR) END
      store_number FROM lineitem""",
)(
    lambda v: v.table("lineitem")
    .select("l_partkey", T.pad_store(F.col("l_partkey") * 37).alias("store_number"))
    .distinct()
)
query(
    "f02_strip_zeros",
    """SELECT s_name, ltrim(substr(s_name, 10), '0') stripped FROM supplier""",
)(
    lambda v: v.table("supplier").select(
        "s_name", T.strip_zeros(F.substring("s_name", 10, 20)).alias("stripped")
    )
)
query(
    "f03_time_grid",
    """SELECT g."interval", count(q.timequarter) seen FROM time_grid g LEFT JOIN sales_15min q
    ON strftime(q.timequarter, '%H:%M:%S') = g."interval" GROUP BY 1""",
)(
    lambda v: C.time_grid(v.spark)
    .join(
        v.sales_15min.select(C.time_of_day(F.col("timequarter")).alias("interval"), "timequarter"),
        "interval",
        "left",
    )
    .groupBy("interval")
    .agg(F.count("timequarter").alias("seen"))
)
query(
    "f04_f05_interval_start",
    """SELECT location_num, timequarter, strftime(timequarter, '%H:%M:%S') AS time,
      concat(CAST(business_date AS VARCHAR), 'T', strftime(timequarter, '%H:%M:%S')) started,
      concat(CAST(business_date AS VARCHAR), 'T00:00:00') day_started FROM latest_sales_15min""",
)(
    lambda v: v.latest_sales_15min.select(
        LOC,
        "timequarter",
        C.time_of_day(F.col("timequarter")).alias("time"),
        C.interval_start(F.col(DAY), C.time_of_day(F.col("timequarter"))).alias("started"),
        C.day_start(F.col(DAY)).alias("day_started"),
    )
)
query(
    "f06_last_year_date",
    f"""SELECT business_date, {last_year("business_date")} ly_date,
      CAST(business_date - {last_year("business_date")} AS INTEGER) days_back
    FROM calendar_daily""",
)(
    lambda v: v.calendar_daily.select(
        DAY,
        C.last_year_date(F.col(DAY)).alias("ly_date"),
        F.datediff(DAY, C.last_year_date(F.col(DAY))).alias("days_back"),
    )
)
query(
    "f07_f09_date_arithmetic",
    """SELECT location_num, prediction_date, prediction_date - 364 ly_fiscal_date,
      prediction_date - 364 - 7 * lookup_weeks ly_min_date,
      CAST(prediction_date - DATE '2001-07-01' AS INTEGER) ahead FROM control""",
)(
    lambda v: control(v).select(
        LOC,
        "prediction_date",
        C.fiscal_last_year(F.col("prediction_date")).alias("ly_fiscal_date"),
        F.expr("date_sub(prediction_date, 364 + 7 * lookup_weeks)").alias("ly_min_date"),
        F.datediff("prediction_date", F.lit(AS_OF)).alias("ahead"),
    )
)
query(
    "f08_f10_weekdays_holidays",
    f"""SELECT business_date, CAST(dayofweek(business_date) + 1 AS INTEGER) dow_sun1,
      CAST(isodow(business_date) - 1 AS INTEGER) dow_mon0,
      CAST(isodow(business_date) AS INTEGER) dow_iso,
      {closed_holiday("business_date")} closed FROM calendar_daily""",
)(
    lambda v: v.calendar_daily.select(
        DAY,
        C.dow_sun1(F.col(DAY)).alias("dow_sun1"),
        C.dow_mon0(F.col(DAY)).alias("dow_mon0"),
        C.dow_iso(F.col(DAY)).alias("dow_iso"),
        C.is_closed_holiday(F.col(DAY)).alias("closed"),
    )
)
query(
    "f11_decimal_cast",
    f"""SELECT l_orderkey, l_linenumber, {dec2("l_extendedprice / 3e0")} third,
      {dec2("l_quantity / 8e0")} eighth FROM lineitem""",
)(
    lambda v: v.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        N.dec2(F.col("l_extendedprice") / 3).alias("third"),
        N.dec2(F.col("l_quantity") / 8).alias("eighth"),
    )
)
query(
    "f12_f13_ratio_uplift",
    """SELECT l_orderkey, l_linenumber, round(change, 6) change,
      round(l_quantity + l_quantity * change * 0.2e0, 6) lifted
    FROM (SELECT *, CASE WHEN l_tax <> 0 THEN (l_discount - l_tax) / l_tax ELSE 0 END change
      FROM lineitem)""",
)(
    lambda v: _round(
        v.table("lineitem")
        .withColumn("change", N.safe_ratio(F.col("l_discount"), F.col("l_tax")))
        .select(
            "l_orderkey",
            "l_linenumber",
            "change",
            N.uplift(F.col("l_quantity"), F.col("change"), F.lit(0.2)).alias("lifted"),
        ),
        "change",
        "lifted",
    )
)
query(
    "f14_us_date",
    """SELECT business_date, strftime(business_date, '%m-%d-%Y') us, business_date back
    FROM calendar_daily""",
)(
    lambda v: v.calendar_daily.select(DAY, C.us_date(F.col(DAY)).alias("us")).withColumn(
        "back", C.parse_us_date(F.col("us"))
    )
)
query(
    "f15_parse_key",
    """SELECT DISTINCT location_num parsed_partition, lpad(CAST(location_num AS VARCHAR), 5, '0')
      parsed_store, business_date parsed_date FROM lines""",
)(
    lambda v: v.lines.select(
        F.format_string(
            "forecast/main/%05d/demand-%s.json", F.col(LOC), C.us_date(F.col(DAY))
        ).alias("path"),
        F.format_string("location_num=%05d", F.col(LOC)).alias("entry"),
    )
    .select(
        T.partition_store(F.col("entry")).alias("parsed_partition"),
        T.document_store(F.col("path")).alias("parsed_store"),
        T.document_date(F.col("path")).alias("parsed_date"),
    )
    .distinct()
)
query(
    "f16_business_today",
    # every other event half a year later, when summer time holds
    """SELECT event_id, CAST(CASE WHEN event_id % 2 = 0 THEN ts - INTERVAL 5 HOUR
      ELSE ts + INTERVAL 180 DAY - INTERVAL 4 HOUR END AS DATE) business_day FROM events""",
)(
    lambda v: v.table("events").select(
        "event_id",
        C.business_today(
            F.to_utc_timestamp(
                F.col("ts").cast("timestamp")
                + F.expr("CASE WHEN event_id % 2 = 0 THEN INTERVAL '0' DAY ELSE INTERVAL '180' DAY END"),
                "UTC",
            )
        ).alias("business_day"),
    )
)
query(
    "f17_limit_band",
    """SELECT location_num, weekday, metric, round(median - 0.35e0 * median, 8) min_limit,
      round(median + 0.35e0 * median, 8) max_limit FROM limits_all""",
)(lambda v: _band(v))
query(
    "f18_one_hot",
    """SELECT business_date,
      CASE WHEN federalholiday_name = 'Christmas-Day' THEN 1 ELSE 0 END "holiday_Christmas-Day",
      CASE WHEN federalholiday_name = 'Regular-day' THEN 1 ELSE 0 END "holiday_Regular-day",
      0 "holiday_Labor-Day" FROM calendar_daily""",
)(
    lambda v: U.one_hot(
        v.calendar_daily,
        "federalholiday_name",
        ["Christmas-Day", "Regular-day", "Labor-Day"],
        "holiday",
    ).select(DAY, "`holiday_Christmas-Day`", "`holiday_Regular-day`", "`holiday_Labor-Day`")
)
V["scales"] = """
  SELECT location_num l, median(x) m, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) i
  FROM (SELECT location_num, CASE WHEN location_num % 5 = 0 THEN 1e0
    ELSE CAST(sales_sub_total AS DOUBLE) END x FROM latest_sales_daily) GROUP BY 1"""
query(
    "f19_robust_scale",
    """SELECT location_num, business_date, round(scaled, 6) scaled,
      round(CASE WHEN i <> 0 THEN scaled * i + m ELSE scaled END, 2) unscaled
    FROM (SELECT *, CASE WHEN i <> 0 THEN (CAST(sales_sub_total AS DOUBLE) - m) / i
      ELSE CAST(sales_sub_total AS DOUBLE) END scaled
      FROM latest_sales_daily JOIN scales ON l = location_num)""",
)(lambda v: _scaled(v))


def _with_last_year(v: Views) -> DataFrame:
    time = C.time_of_day(F.col("timequarter")).alias("time")
    now = v.latest_sales_15min.select(
        LOC, DAY, time, "sales_sub_total", C.last_year_date(F.col(DAY)).alias("_ly")
    )
    then = v.latest_sales_15min.select(
        LOC, F.col(DAY).alias("_ly"), time, F.col("sales_sub_total").alias("lastyearsales")
    )
    return now.join(then, [LOC, "_ly", "time"]).drop("_ly")


def _band(v: Views) -> DataFrame:
    low, high = N.limit_band(F.col("median"))
    return all_limits(v).select(
        LOC,
        "weekday",
        "metric",
        F.round(low, 8).alias("min_limit"),
        F.round(high, 8).alias("max_limit"),
    )


def _scaled(v: Views) -> DataFrame:
    x = F.col("sales_sub_total").cast("double")
    shown = F.when(F.col(LOC) % 5 == 0, F.lit(1.0)).otherwise(x)
    shares = {"q1": 0.25, "m": 0.5, "q3": 0.75}
    scales = exact_quantiles(v.latest_sales_daily.select(LOC, shown.alias("x")), [LOC], "x", shares)
    m, i = F.col("m"), F.col("q3") - F.col("q1")
    scaled = v.latest_sales_daily.join(scales, LOC).withColumn("s", N.robust_scale(x, m, i))
    return scaled.select(
        LOC,
        DAY,
        F.round("s", 6).alias("scaled"),
        F.round(N.robust_unscale(F.col("s"), m, i), 2).alias("unscaled"),
    )

"""Baseline forecast: comparable past days, last-year trend, interval averages.

The steps form one lazy plan over all stores: no store batches, no driver
round trip, no intermediate table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.calendar import fiscal_last_year, horizon_dates
from tillcast.functions.numeric import planned_mean, safe_ratio, uplift
from tillcast.operators.joins import explode_recipe, mean_yield, scaffold
from tillcast.operators.predicates import operable_dates, parse_settings
from tillcast.operators.snapshot import dedupe_latest, not_before
from tillcast.operators.windows import recent_same_weekday, trim_extremes, with_survivors

LOC = "location_num"
STAPLES = (160001, 403614, 160067)  # fixed values: items sold on every open day


def control_table(
    stores: DataFrame, settings: DataFrame, as_of: date, reduce_long: bool
) -> DataFrame:
    """Store, prediction date, lookup weeks and smoothing for both horizons."""
    short = horizon_dates(as_of, "short")
    dates = short + horizon_dates(as_of, "long")
    control = parse_settings(stores, settings)
    control = scaffold(control, dates).withColumnRenamed("business_date", "prediction_date")
    if reduce_long:
        is_long = F.col("prediction_date") > F.lit(short[-1])
        fewer = F.col("lookup_weeks") - F.when(is_long, 1).otherwise(0)
        control = control.withColumn("lookup_weeks", fewer)
    return control


def baseline_dates(
    daily: DataFrame,
    items: DataFrame,
    settings: DataFrame,
    stores: DataFrame,
    sat_off: DataFrame,
    as_of: date,
    staples: tuple[int, ...] = STAPLES,
) -> DataFrame:
    """Which past days feed each prediction date of each store.

    Candidates are a store's days on the same weekday with a staple item sold.
    The newest ``lookup_weeks - 1`` are kept, the days with the lowest and
    highest sales dropped, and the rest counted.  However dense the history,
    only the rank of a day limits it.
    """
    before = F.col("business_date") < F.lit(as_of)
    recent = dedupe_latest(
        daily.where(before).select(LOC, "business_date", "sales_sub_total", "generation_date"),
        [LOC, "business_date"],
        ["sales_sub_total"],
    ).select(LOC, "business_date", "sales_sub_total")
    sold = items.where(before & F.col("product").isin(*staples)).select(LOC, "business_date")
    candidates = recent.join(sold.distinct(), [LOC, "business_date"], "left_semi").withColumn(
        "dayofweek", F.dayofweek("business_date")
    )

    control = control_table(stores, settings, as_of, reduce_long=True)
    dates = horizon_dates(as_of, "short") + horizon_dates(as_of, "long")
    operable = operable_dates(stores, dates, sat_off)
    wanted = control.join(operable, [LOC, "prediction_date"], "left_semi").select(
        LOC, "prediction_date", "lookup_weeks", F.dayofweek("prediction_date").alias("dayofweek")
    )
    keys = [LOC, "prediction_date"]
    matched = recent_same_weekday(wanted.join(candidates, [LOC, "dayofweek"]), keys)
    kept = with_survivors(trim_extremes(matched, keys, "sales_sub_total"), keys)
    return kept.select(
        LOC,
        "prediction_date",
        "business_date",
        "lookup_weeks",
        "forecast_avg_dr",
        F.lit(as_of).alias("generation_date"),
    )


def baseline_trend(
    daily: DataFrame, settings: DataFrame, stores: DataFrame, as_of: date
) -> DataFrame:
    """Last year's sales on the comparable day against the weeks before it.

    The comparable day and its lookback days have the prediction date's
    weekday, so the days are listed per row and joined by equality; a window
    of dates never has to be scanned.
    """
    control = control_table(stores, settings, as_of, reduce_long=False)
    flat = control.where(F.col("smoothing_fact") == 0).select(
        LOC, "prediction_date", "smoothing_fact", F.lit(0.0).alias("trend")
    )
    seasonal = control.where(F.col("smoothing_fact") != 0).withColumn(
        "ly_fiscal_date", fiscal_last_year(F.col("prediction_date"))
    )
    actuals = dedupe_latest(
        daily.select(LOC, "business_date", "sales_sub_total", "generation_date"),
        [LOC, "business_date"],
        ["sales_sub_total"],
    ).select(LOC, "business_date", "sales_sub_total")

    lookback = seasonal.withColumn(
        "_k", F.explode(F.sequence(F.lit(1), F.col("lookup_weeks")))
    ).withColumn("business_date", F.date_sub("ly_fiscal_date", F.col("_k") * 7))
    keys = [LOC, "prediction_date", "ly_fiscal_date", "lookup_weeks", "smoothing_fact"]
    averages = (
        lookback.join(actuals, [LOC, "business_date"], "left")
        .groupBy(*keys)
        .agg(F.sum("sales_sub_total").cast("double").alias("_sum"))
        .withColumn("ly_sales_avg", F.coalesce("_sum", F.lit(0.0)) / F.col("lookup_weeks"))
    )
    ly_day = actuals.withColumnsRenamed(
        {"business_date": "ly_fiscal_date", "sales_sub_total": "ly_sales"}
    )
    ly_sales = F.coalesce(F.col("ly_sales").cast("double"), F.lit(0.0))
    trend = averages.join(ly_day, [LOC, "ly_fiscal_date"], "left").select(
        LOC,
        "prediction_date",
        "smoothing_fact",
        safe_ratio(ly_sales, F.col("ly_sales_avg")).alias("trend"),
    )
    return trend.unionByName(flat).withColumn("generation_date", F.lit(as_of))


def baseline_forecast(
    facts: DataFrame,
    dates: DataFrame,
    trend: DataFrame,
    stores: DataFrame,
    metrics: list[str],
    as_of: date,
    by: str | None = None,
) -> DataFrame:
    """15-minute forecast of every store, both horizons and all 96 intervals.

    With ``by`` the forecast is per product, for the products seen on the
    fetched days.  Facts are cut to the wanted dates in the scan and to the
    wanted store-dates before versions are resolved, so the large table is
    shuffled only for those days.  Pass ``dates`` and ``trend`` as stored
    control tables where they are used more than once.
    """
    series = [LOC, by] if by else [LOC]
    wanted = dates.select(LOC, "business_date").distinct()
    columns = [*series, "business_date", "timequarter", *metrics, "generation_date"]
    recent = not_before(facts.select(*columns), "business_date", wanted, "business_date")
    fetched = recent.join(wanted, [LOC, "business_date"], "left_semi")
    current = dedupe_latest(
        fetched, [*series, "timequarter"], ["business_date", *metrics]
    ).withColumn("interval", F.substring(F.col("timequarter").cast("string"), 12, 8))

    history = dates.select(
        LOC, "business_date", "prediction_date", "lookup_weeks", "forecast_avg_dr"
    )
    planned = F.first("forecast_avg_dr")
    averages = (
        current.join(history, [LOC, "business_date"])
        .groupBy(*series, "prediction_date", "interval", "lookup_weeks", "forecast_avg_dr")
        .agg(*[planned_mean(F.col(m), planned).alias(m) for m in metrics])
    )
    predicted = averages.join(
        trend.select(LOC, "prediction_date", "trend", "smoothing_fact"), [LOC, "prediction_date"]
    ).select(
        *series,
        F.col("prediction_date").alias("business_date"),
        "interval",
        *[
            uplift(F.col(m), F.col("trend"), F.col("smoothing_fact")).alias(f"forecast_{m}")
            for m in metrics
        ],
    )
    base = fetched.select(*series).distinct() if by else stores.select(LOC).distinct()
    all_dates = horizon_dates(as_of, "short") + horizon_dates(as_of, "long")
    padded = scaffold(base, all_dates, intervals=True).join(
        predicted, [*series, "business_date", "interval"], "left"
    )
    filled = {f"forecast_{m}": F.coalesce(f"forecast_{m}", F.lit(0.0)) for m in metrics}
    return padded.withColumns(filled).withColumn("generation_date", F.lit(as_of))


def baseline_ingredients(
    items: DataFrame, recipe: DataFrame, ycf: DataFrame, as_of: date
) -> DataFrame:
    """Ingredient forecast out of the item forecast.

    Amounts are summed as decimals: the total does not depend on the order in
    which partitions arrive, so a rerun rounds the same way.
    """
    used = F.col("forecast_sum_daily_quantity") * F.col("ycf") * F.col("ingredient_quantity")
    exact = F.sum(used.cast("decimal(28,9)"))
    lines = explode_recipe(items, recipe, mean_yield(ycf))
    return (
        lines.groupBy(LOC, "ingredient_id", "business_date", "interval", "unit_of_measure")
        .agg(F.round(exact, 2).cast("double").alias("sumingredient"))
        .withColumn("generation_date", F.lit(as_of))
    )

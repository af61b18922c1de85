"""Forecasts without a model: trailing medians, and zeros for dormant items."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.calendar import HORIZONS, date_array, horizon_dates
from tillcast.functions.series import recursive_median
from tillcast.operators.joins import without
from tillcast.operators.predicates import split_horizons

LOC = "location_num"
PAIR = [LOC, "product"]
WINDOW, STEPS = 30, 34


def unmodelled_pairs(initial_items: DataFrame, combinations: DataFrame) -> DataFrame:
    """Pairs without a model, with their newest business date."""
    pairs = initial_items.groupBy(*PAIR).agg(F.max("business_date").alias("max_business_date"))
    return without(pairs, combinations, PAIR)


def active_pairs(pairs: DataFrame, as_of: date, days: int = WINDOW) -> DataFrame:
    return pairs.where(F.col("max_business_date") >= F.lit(as_of - timedelta(days=days)))


def dormant_pairs(pairs: DataFrame, as_of: date, days: int = WINDOW) -> DataFrame:
    return pairs.where(F.col("max_business_date") < F.lit(as_of - timedelta(days=days)))


def naive_forecast(
    sales: DataFrame, pairs: DataFrame, holidays: DataFrame, as_of: date
) -> DataFrame:
    """Recursive trailing median of active pairs, by horizon; 0 on holidays.

    A pair's 30 daily totals are summed per date first, so the list built for
    it has at most 30 entries however many fact rows it has.
    """
    last = as_of - timedelta(days=2)
    first = last - timedelta(days=WINDOW - 1)
    in_window = F.col("business_date").between(F.lit(first), F.lit(last))
    daily = (
        sales.where(in_window)
        .join(pairs.select(*PAIR), PAIR, "left_semi")
        .groupBy(*PAIR, "business_date")
        .agg(F.sum("sum_daily_quantity").cast("double").alias("_qty"))
    )
    by_day = daily.groupBy(*PAIR).agg(
        F.map_from_entries(F.collect_list(F.struct("business_date", "_qty"))).alias("_by_day")
    )
    days = F.sequence(F.lit(first), F.lit(last))
    history = F.transform(days, lambda d: F.coalesce(F.col("_by_day")[d], F.lit(0.0)))
    series = by_day.select(*PAIR, recursive_median(history, WINDOW, STEPS).alias("_series"))
    future = F.slice("_series", WINDOW + 1, STEPS)
    rows = series.select(*PAIR, F.posexplode(future).alias("_step", "forecast")).withColumn(
        "business_date", F.date_add(F.lit(last), F.col("_step") + 1)
    )
    out = split_horizons(rows.drop("_step"), as_of)
    return _stamp(_zero_on(out, holidays), as_of)


def zero_forecast(pairs: DataFrame, as_of: date) -> DataFrame:
    """0 on every horizon date of the pairs."""
    dates = [d for h in HORIZONS for d in horizon_dates(as_of, h)]
    rows = pairs.select(*PAIR).distinct().withColumn("business_date", F.explode(date_array(dates)))
    return _stamp(split_horizons(rows.withColumn("forecast", F.lit(0.0)), as_of), as_of)


def _zero_on(df: DataFrame, holidays: DataFrame) -> DataFrame:
    marked = holidays.select("business_date", F.lit(True).alias("_holiday")).distinct()
    return (
        df.join(marked, "business_date", "left")
        .withColumn("forecast", F.when(F.col("_holiday"), F.lit(0.0)).otherwise(F.col("forecast")))
        .drop("_holiday")
    )


def _stamp(df: DataFrame, as_of: date) -> DataFrame:
    return df.select(
        *PAIR, "business_date", "horizon", "forecast", F.lit(as_of).alias("generation_date")
    )

"""Incremental preparation of facts: complete scaffolds, gaps filled with 0."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.calendar import time_of_day
from tillcast.operators.joins import explode_recipe, pad
from tillcast.operators.predicates import closed_flag
from tillcast.operators.snapshot import incremental_bounds, incremental_slice, not_before

LOC = "location_num"
# Calendar features carried into the daily tables.
FEATURES = [
    "aroundthanksgiving",
    "aroundchristmas",
    "onedaypriorchristmas_and_new_year",
    "federalholiday",
    "holiday",
    "blackfridaycheck",
    "dayofweek",
    "sunday",
    "federalholiday_name",
]
FIRST_DATE = date(2018, 1, 1)  # fixed value: start of an empty ingredient history


def _actuals(initial: DataFrame, bounds: DataFrame) -> DataFrame:
    """Facts after the store's last prepared date."""
    after = bounds.select(LOC, "_after")
    recent = not_before(initial, "business_date", after, "_after")
    return recent.join(after, LOC).where(F.col("business_date") > F.col("_after")).drop("_after")


def prep_metrics_15min(
    calendar_15min: DataFrame, final: DataFrame, initial: DataFrame, as_of: date
) -> DataFrame:
    bounds = incremental_bounds(final, initial)
    grid = incremental_slice(calendar_15min.select("business_date", "timequarter"), bounds)
    keys = [LOC, "business_date", "timequarter"]
    return pad(grid, _actuals(initial, bounds), keys, ["sales_sub_total", "trans_count"]).select(
        *keys, "sales_sub_total", "trans_count", F.lit(as_of).alias("generation_date")
    )


def prep_metrics_daily(
    calendar: DataFrame, final: DataFrame, initial: DataFrame, sat_off: DataFrame, as_of: date
) -> DataFrame:
    bounds = incremental_bounds(final, initial)
    grid = incremental_slice(calendar.select("business_date", *FEATURES), bounds)
    measures = ["sales_sub_total", "trans_count"]
    filled = pad(grid, _actuals(initial, bounds), [LOC, "business_date"], measures)
    return (
        closed_flag(filled, sat_off, "weekends")
        .drop("sunday")
        .withColumn("generation_date", F.lit(as_of))
    )


def _item_grid(
    calendar: DataFrame, final_daily: DataFrame, initial_daily: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Every product of a store on every calendar row of the store's range.

    The date range joins on the store and is expanded per product row, so the
    grid is as wide as products x dates and is built without a cross join.
    """
    bounds = incremental_bounds(final_daily, initial_daily, newest_load_only=True)
    products = initial_daily.select(LOC, "product").distinct()
    return incremental_slice(calendar, products.join(bounds, LOC)), bounds


def prep_items_15min(
    calendar_15min: DataFrame,
    final_daily: DataFrame,
    initial_daily: DataFrame,
    initial_15min: DataFrame,
    as_of: date,
) -> DataFrame:
    grid, bounds = _item_grid(
        calendar_15min.select("business_date", "timequarter"), final_daily, initial_daily
    )
    keys = [LOC, "product", "business_date", "timequarter"]
    return pad(grid, _actuals(initial_15min, bounds), keys, ["sum_daily_quantity"]).select(
        *keys, "sum_daily_quantity", F.lit(as_of).alias("generation_date")
    )


def prep_items_daily(
    calendar: DataFrame, final_daily: DataFrame, initial_daily: DataFrame, as_of: date
) -> DataFrame:
    grid, bounds = _item_grid(
        calendar.select("business_date", *FEATURES), final_daily, initial_daily
    )
    keys = [LOC, "product", "business_date"]
    return pad(grid, _actuals(initial_daily, bounds), keys, ["sum_daily_quantity"]).withColumn(
        "generation_date", F.lit(as_of)
    )


def prep_ingredients(
    items_15min: DataFrame,
    ingredients: DataFrame,
    recipe: DataFrame,
    as_of: date,
    first_date: date = FIRST_DATE,
) -> DataFrame:
    """Ingredient usage of the items sold after the last prepared date."""
    bounds = incremental_bounds(ingredients, items_15min, default=first_date)
    sold = _actuals(items_15min, bounds)
    used = F.col("sum_daily_quantity") * F.col("ingredient_quantity")
    return (
        explode_recipe(sold, recipe, None)
        .groupBy("business_date", LOC, "ingredient_id", "unit_of_measure", "timequarter")
        .agg(F.sum(used).alias("ingredient_quantity"))
        .withColumn("quarters", time_of_day(F.col("timequarter")))
        .withColumn("generation_date", F.lit(as_of))
    )

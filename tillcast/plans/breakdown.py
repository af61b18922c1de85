"""Daily forecasts broken down to quarter-hours and to ingredients."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.calendar import quarter_hours
from tillcast.functions.numeric import dec2
from tillcast.operators.joins import explode_recipe, mean_yield
from tillcast.operators.predicates import closed_day, mask_closed, with_saturday_off
from tillcast.operators.snapshot import latest_snapshot

LOC = "location_num"
DAY = "business_date"

# Even spread over the quarter-hours 06:00 .. 22:00, both included.
OPEN_FROM, OPEN_TO, OPEN_INTERVALS = "06:00:00", "22:00:00", 65


def breakdown_metrics(
    sales: DataFrame,
    trans: DataFrame,
    sales_ratios: DataFrame,
    trans_ratios: DataFrame,
    sat_off: DataFrame,
    as_of: date,
    snapshot_ratios: bool = True,
) -> DataFrame:
    """Sales and transaction forecasts of a day times their interval ratios.

    The redundancy flavour passes ``snapshot_ratios=False``: every stored
    version of the ratios is used.
    """

    def newest(df: DataFrame) -> DataFrame:
        return latest_snapshot(df, keys=[LOC])

    ratios_1 = newest(sales_ratios) if snapshot_ratios else sales_ratios
    ratios_2 = newest(trans_ratios) if snapshot_ratios else trans_ratios
    daily = (
        newest(sales)
        .select(LOC, DAY, "forecast")
        .join(newest(trans).select(LOC, DAY, F.col("forecast").alias("forecast_trans")), [LOC, DAY])
    )
    ratios = ratios_1.select(LOC, DAY, "time", "ratio").join(
        ratios_2.select(LOC, DAY, "time", F.col("ratio").alias("ratio_trans")), [LOC, DAY, "time"]
    )
    product = ratios.join(daily, [LOC, DAY]).withColumns(
        {
            "min15_forecast": F.col("forecast") * F.col("ratio"),
            "min15_forecast_trans": F.col("forecast_trans") * F.col("ratio_trans"),
        }
    )
    masked = mask_closed(product, sat_off, ["min15_forecast", "min15_forecast_trans"])
    return masked.select(
        DAY,
        F.col("time").alias("timequarter"),
        dec2(F.col("min15_forecast")).alias("min15_forecast"),
        dec2(F.col("min15_forecast_trans")).alias("min15_forecast_trans"),
        F.lit(as_of).alias("generation_date"),
        LOC,
    ).distinct()


def breakdown_items(
    forecast: DataFrame, ratios: DataFrame, sat_off: DataFrame, as_of: date
) -> DataFrame:
    """Item forecasts of a day by ratio, or evenly where a pair has no ratio.

    A left join with the ratios serves both cases: rows without a match are
    expanded to the 96 quarter-hours inside the row.
    """
    keys = [LOC, DAY, "product"]
    newest = latest_snapshot(forecast, keys=[LOC, DAY]).select(
        LOC, DAY, F.col("item_id").alias("product"), "forecast"
    )
    known = ratios.distinct().select(*keys, "time", "ratio", F.lit(True).alias("_known"))
    joined = newest.join(known, keys, "left")
    times = F.when(F.col("_known"), F.array("time")).otherwise(quarter_hours())
    spread = with_saturday_off(joined, sat_off).withColumn("timequarter", F.explode(times))
    by_ratio = dec2(F.col("forecast") * F.col("ratio"))
    evenly = F.when(
        F.col("timequarter").between(OPEN_FROM, OPEN_TO), dec2(F.col("forecast") / OPEN_INTERVALS)
    ).otherwise(dec2(F.lit(0)))
    value = F.when(closed_day(F.col(DAY), F.col("_sat_off")), dec2(F.lit(0))).otherwise(
        F.when(F.col("_known"), by_ratio).otherwise(evenly)
    )
    return spread.select(
        DAY,
        "product",
        "timequarter",
        value.alias("min15_forecast"),
        F.lit(as_of).alias("generation_date"),
        LOC,
    ).distinct()


def breakdown_ingredients(
    items: DataFrame, recipe: DataFrame, ycf: DataFrame, as_of: date, redundancy: bool = False
) -> DataFrame:
    """15-minute ingredient forecast out of the 15-minute item forecast.

    The redundancy flavour keeps repeated item rows, every recipe version and
    every distinct yield factor instead of their mean.
    """
    newest = latest_snapshot(items, keys=[LOC, DAY]).select(
        "forecast", DAY, LOC, F.col("item_id").alias("product"), "interval_start_time"
    )
    factors = latest_snapshot(ycf, keys=[LOC])
    lines = recipe.select("pin", "ingredient_quantity", "ingredient_id", "unit_of_measure")
    if redundancy:
        factors = factors.select(
            LOC, "ingredient_id", F.coalesce("ycf", F.lit(1.0)).alias("ycf")
        ).distinct()
    else:
        newest = newest.distinct()
        lines = (
            latest_snapshot(recipe)
            .select("pin", "ingredient_quantity", "ingredient_id", "unit_of_measure")
            .distinct()
        )
        factors = mean_yield(factors)
    used = dec2(F.col("forecast") * F.col("ingredient_quantity") * F.col("ycf"))
    return (
        explode_recipe(newest, lines, factors)
        .groupBy(DAY, LOC, "ingredient_id", "unit_of_measure", "interval_start_time")
        .agg(F.sum(used).alias("sumingredient"))
        .withColumn("generation_date", F.lit(as_of))
    )


def breakdown_dates(forecast: DataFrame, item: int | None = None) -> DataFrame:
    """Dates of each store's newest run; for ingredients those of one staple item."""
    rows = forecast if item is None else forecast.where(F.col("item_id") == item)
    return latest_snapshot(rows, keys=[LOC]).select(LOC, DAY).distinct()

"""Expected band per store and weekday out of recent regular days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.operators.aggregates import repair_medians, weekday_stats
from tillcast.operators.predicates import regular_days
from tillcast.operators.snapshot import GENERATION, top_n_by

LOC = "location_num"
WINDOW = {"LSTM": 56, "baseline": 35}  # fixed values: dates looked back, by forecast type


def _recent_regular(
    per_day: DataFrame, calendar: DataFrame, window: int, drop_sunday: bool
) -> DataFrame:
    """Of each store's newest dates the regular ones with a demand."""
    recent = top_n_by(per_day, [LOC], [F.desc("business_date")], window)
    rows = regular_days(recent.where(F.col("demand").isNotNull()), calendar, drop_sunday)
    return rows.withColumn("weekday", F.weekday("business_date"))


def _newest_version_total(facts: DataFrame, value: Column) -> DataFrame:
    """Per store and date the total of the newest version that has a value.

    Totals per version come first, with map-side partial sums, so the facts
    are read once and never joined with their own maximum.
    """
    versions = facts.groupBy(LOC, "business_date", GENERATION).agg(F.sum(value).alias("_total"))
    with_value = F.when(F.col("_total").isNotNull(), F.col(GENERATION))
    return versions.groupBy(LOC, "business_date").agg(
        F.max_by("_total", with_value).alias("demand")
    )


def daily_demand(facts: DataFrame, calendar: DataFrame, measure: str, window: int) -> DataFrame:
    """Newest-version totals of regular non-Sunday days among the newest dates."""
    per_day = _newest_version_total(facts, F.col(measure))
    return _recent_regular(per_day, calendar, window, drop_sunday=True)


def item_demand(
    facts: DataFrame, calendar: DataFrame, window: int, item: int = 160001
) -> DataFrame:
    """Same for one item; the newest dates are those of all items."""
    per_day = _newest_version_total(
        facts, F.when(F.col("product") == item, F.col("sum_daily_quantity"))
    )
    return _recent_regular(per_day, calendar, window, drop_sunday=True)


def ingredient_demand(
    facts: DataFrame, calendar: DataFrame, window: int, ingredient: int = 1
) -> DataFrame:
    """Same for one ingredient; here Sundays and old versions count too."""
    used = F.when(F.col("ingredient_id") == ingredient, F.col("ingredient_quantity"))
    per_day = facts.groupBy(LOC, "business_date").agg(F.sum(used).alias("demand"))
    return _recent_regular(per_day, calendar, window, drop_sunday=False)


def weekday_limits(demand: DataFrame) -> DataFrame:
    return repair_medians(weekday_stats(demand, bounded=True))

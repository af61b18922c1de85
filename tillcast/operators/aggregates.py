"""Grouped aggregates.  Everything combines map-side before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.operators.segments import exact_quantiles, matched

LOC = "location_num"


def coverage(df: DataFrame, keys: list[str], item: str | None = None) -> DataFrame:
    """Rows, and distinct items if asked, per key."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    if item:
        aggs.append(F.countDistinct(item).alias("item_count"))
    return df.groupBy(*keys).agg(*aggs)


def flag_counts(
    alerts: DataFrame, flags: dict[str, Column], key: str = "business_date"
) -> DataFrame:
    """Per date the number of distinct stores for which each flag holds.

    One pass over the alert rows.  A store is first reduced to one row per
    date, so the counts are plain sums.
    """
    per_store = alerts.groupBy(key, LOC).agg(
        *[F.max(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in flags.items()]
    )
    return per_store.groupBy(key).agg(
        *[F.sum(F.when(F.col(LOC).isNotNull(), F.col(n)).otherwise(0)).alias(n) for n in flags]
    )


def weekday_stats(df: DataFrame, demand: str = "demand", bounded: bool = False) -> DataFrame:
    """Min, max, mean, median, sample deviation and IQR per store and weekday.

    The quartiles are selected by running totals of counted values, so no store's values
    are gathered, however many there are.  ``bounded`` says that the caller's dates leave
    a few weeks per store; a buffer of these is cheaper then.
    """
    keys, value = [LOC, "weekday"], F.col(demand).cast("double")
    plain = [
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
    ]
    if bounded:
        quartiles = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
        both = df.groupBy(*keys).agg(*plain, quartiles.alias("_q"))
        both = both.select("*", *(F.col("_q")[k].alias(n) for k, n in enumerate(("_q1", "median", "_q3"))))
    else:
        shares = {"_q1": 0.25, "median": 0.5, "_q3": 0.75}
        found = exact_quantiles(df.select(*keys, value.alias("_x")), keys, "_x", shares)
        both = matched(df.groupBy(*keys).agg(*plain), found, keys)
    return both.select(
        *keys, "min_value", "max_value", "mean", "median", "std", (F.col("_q3") - F.col("_q1")).alias("iqr")
    )


STATS = ["min_value", "max_value", "mean", "median", "std", "iqr"]


def repair_medians(stats: DataFrame, share: float = 0.15) -> DataFrame:
    """All weekdays 0-5 of a store, with implausibly low medians replaced.

    A median at or below ``share`` of the median of the non-zero medians takes
    that median.  Missing weekdays count as 0 and so are repaired too.
    """
    # A store has at most seven weekdays, so they are gathered in one row.
    values = F.struct(*[F.coalesce(s, F.lit(0.0)).alias(s) for s in STATS])
    stores = stats.groupBy(LOC).agg(
        F.median(F.when(F.col("median") != 0, F.col("median"))).alias("_typical"),
        F.map_from_entries(F.collect_list(F.struct(F.col("weekday"), values))).alias("_stats"),
    )
    days = F.array_union(F.sequence(F.lit(0), F.lit(5)), F.map_keys("_stats"))
    filled = stores.withColumn("weekday", F.explode(days)).select(
        LOC,
        "weekday",
        "_typical",
        *[F.coalesce(F.col("_stats")[F.col("weekday")][s], F.lit(0.0)).alias(s) for s in STATS],
    )
    too_low = F.col("median") <= F.lit(share) * F.col("_typical")
    return filled.withColumn(
        "median", F.when(too_low, F.col("_typical")).otherwise(F.col("median"))
    ).drop("_typical")


def frequent_weekdays(
    daily: DataFrame, since: Column, at_least: int = 3
) -> DataFrame:
    """Stores with enough rows on a weekday since a date, per weekday."""
    recent = daily.where(F.col("business_date") >= since)
    per_day = recent.groupBy(LOC, "business_date").agg(F.count(F.lit(1)).alias("cnt"))
    return (
        per_day.withColumn("weekday", F.weekday("business_date"))
        .groupBy(LOC, "weekday")
        .agg(F.sum("cnt").alias("cnt"))
        .where(F.col("cnt") >= at_least)
    )


def rollup_daily(intervals: DataFrame, measures: list[str], keys: list[str]) -> DataFrame:
    return intervals.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def all_passed(checks: DataFrame, flag: str = "forecast_qc") -> DataFrame:
    """One row per store; it passes only if every date passed."""
    return checks.groupBy(LOC).agg(F.min(flag).alias(flag))


def weekday_quantiles(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    x = df.select(*keys, "dayofweek", F.col(value).cast("double").alias("_x"))
    return exact_quantiles(x, [*keys, "dayofweek"], "_x", {"q1": 0.25, "q3": 0.75, "median": 0.5})


def distinct_days(dates: DataFrame) -> DataFrame:
    """Distinct history days per control key."""
    keys = [LOC, "prediction_date", "lookup_weeks", "forecast_avg_dr"]
    return dates.groupBy(*keys).agg(F.countDistinct("business_date").alias("row_count"))


def date_bounds(df: DataFrame, low: str, high: str) -> DataFrame:
    return df.groupBy(LOC).agg(F.min(low).alias("min_date"), F.max(high).alias("max_date"))


def missing_per_date(missing: DataFrame) -> DataFrame:
    return missing.groupBy("business_date").agg(F.count(LOC).alias("missing_count"))


def products_per_store(items: DataFrame, item: str = "product") -> DataFrame:
    return items.select(LOC, item).distinct().groupBy(LOC).agg(F.count(item).alias("products"))


def value_lists(df: DataFrame, keys: list[str], value: str, by: str) -> DataFrame:
    """Values and dates kept beside their sum, in date order.

    Meant for the few history days of one interval; the lists are as long as
    the lookback.
    """
    points = F.array_sort(F.collect_list(F.struct(F.col(by), F.col(value))))
    return (
        df.groupBy(*keys)
        .agg(points.alias("_points"), F.sum(value).alias(f"sum_{value}"))
        .withColumn("dates_list", F.col(f"_points.{by}"))
        .withColumn("metric_values", F.col(f"_points.{value}"))
        .drop("_points")
    )

"""Checks of documents before delivery, alert summaries and missing documents."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.numeric import limit_band
from tillcast.functions.text import pad_store
from tillcast.operators.aggregates import flag_counts, frequent_weekdays, missing_per_date
from tillcast.operators.joins import scaffold
from tillcast.operators.predicates import with_saturday_off

LOC = "location_num"
DAY = "business_date"
KEY = [LOC, DAY]
FLAT_ROWS = 65  # fixed value: quarter-hours of an evenly spread day
METRICS = ["dollarsales", "transcount", "itemcount", "ingredient"]


def flat_flags(rows: DataFrame, value: str, name: str, order: list[str]) -> DataFrame:
    """Whether a document shows two values, the second one 65 times.

    "Second" means second to appear.  Rows are first counted per value, so a
    document contributes a handful of rows to the second step.
    """
    per_value = rows.groupBy(*KEY, value).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(*order)).alias("_first_seen")
    )
    return per_value.groupBy(*KEY).agg(
        F.when(
            (F.count(F.lit(1)) == 2) & (F.max_by("_n", "_first_seen") == FLAT_ROWS), 1
        )
        .otherwise(0)
        .alias(name)
    )


def document_flat_flags(
    header: DataFrame,
    metrics: DataFrame,
    items: DataFrame,
    ingredients: DataFrame,
    item: str = "160001",
    ingredient: str = "1",
) -> DataFrame:
    """The four flat flags of every document; 0 where it has no such rows."""
    seen = ["servicetype", "intervalstart"]
    parts = {
        "dollarsales_flat": flat_flags(metrics, "sales", "dollarsales_flat", seen),
        "transcount_flat": flat_flags(metrics, "transactioncount", "transcount_flat", seen),
        "itemcount_flat": flat_flags(
            items.where(F.col("code") == item), "transactioncount", "itemcount_flat", seen
        ),
        "ingredient_flat": flat_flags(
            ingredients.where(F.col("code") == ingredient),
            "transactioncount",
            "ingredient_flat",
            seen,
        ),
    }
    out = header.select(*KEY).distinct()
    for part in parts.values():
        out = out.join(part, KEY, "left")
    return out.na.fill(0, list(parts))


def document_totals(
    metrics: DataFrame,
    items: DataFrame,
    ingredients: DataFrame,
    item: str = "160001",
    ingredient: str = "1",
) -> DataFrame:
    """Per document and metric the total to check, and the Sunday total.

    Items and ingredients are checked on one staple code; on Sundays the total
    over all codes has to be 0.
    """

    def of(rows: DataFrame, metric: str, measure: str, checked: Column | None) -> DataFrame:
        value = F.col(measure)
        total = value if checked is None else F.when(checked, value).otherwise(F.lit(0))
        return rows.groupBy(*KEY).agg(
            F.lit(metric).alias("metric"),
            F.sum(total).cast("double").alias("total"),
            F.sum(value).cast("double").alias("sunday_total"),
        )

    return (
        of(metrics, "dollarsales", "sales", None)
        .unionByName(of(metrics, "transcount", "transactioncount", None))
        .unionByName(of(items, "itemcount", "transactioncount", F.col("code") == item))
        .unionByName(
            of(ingredients, "ingredient", "transactioncount", F.col("code") == ingredient)
        )
    )


def limit_flags(totals: DataFrame, limits: DataFrame, share: float = 0.35) -> DataFrame:
    """Total of every document and metric against its weekday band.

    ``limits`` has location_num, weekday, metric and median.  At or below 90%
    of the lower limit fails, between that and the limit warns; from 1.5 times
    the upper limit fails, between warns; a Sunday must total 0.
    """
    low, high = limit_band(F.col("median"), share)
    banded = limits.select(
        LOC, "weekday", "metric", low.alias("min_limit"), high.alias("max_limit")
    )
    joined = totals.withColumn("weekday", F.weekday(DAY)).join(
        banded, [LOC, "weekday", "metric"], "left"
    )
    total = F.col("total")
    zero = F.lit(0.0)
    sunday = F.col("weekday") == 6
    under = total <= F.greatest(zero, F.col("min_limit"))
    far_under = total <= F.greatest(zero, F.col("min_limit") * F.lit(0.9))
    over = ~under & (total >= F.col("max_limit"))
    far_over = over & (total >= F.col("max_limit") * F.lit(1.5))

    def flag(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    bad_sunday = sunday & (F.col("sunday_total") != 0)
    return joined.select(
        *KEY,
        "metric",
        "total",
        "min_limit",
        "max_limit",
        flag(~sunday).alias("generated_successfully"),
        flag(~bad_sunday).alias("sunday_zeros"),
        flag(~sunday & under).alias("less_than_min"),
        flag(~sunday & under & far_under).alias("less_than_90_min"),
        flag(~sunday & over).alias("greater_than_max"),
        flag(~sunday & far_over).alias("greater_than_15_max"),
        flag(bad_sunday | (~sunday & ((under & far_under) | far_over))).alias("failed"),
        flag(~sunday & ((under & ~far_under) | (over & ~far_over))).alias("warned"),
    )


def alert_rows(flats: DataFrame, checks: DataFrame) -> DataFrame:
    """One wide row per document: values, limits and flags of every metric, and the verdict."""
    measured = {"val": "total", "min_limit": "min_limit", "max_limit": "max_limit"}
    names = [
        "generated_successfully",
        "sunday_zeros",
        "less_than_min",
        "less_than_90_min",
        "greater_than_max",
        "greater_than_15_max",
    ]
    wide = checks.groupBy(*KEY).agg(
        *[
            F.max(F.when(F.col("metric") == m, F.col(n))).alias(f"{m}_{n}")
            for m in METRICS
            for n in names
        ],
        *[
            F.max(F.when(F.col("metric") == m, F.col(src))).alias(f"{m}_{name}")
            for m in METRICS
            for name, src in measured.items()
        ],
        F.sum("failed").alias("_failed"),
        F.max("warned").alias("warning"),
        F.count(F.lit(1)).alias("_metrics"),
    )
    flat = sum((F.col(f"{m}_flat") for m in METRICS[1:]), F.col(f"{METRICS[0]}_flat"))
    # A document without any row for a metric has no forecast for it and fails.
    missing = F.lit(len(METRICS)) - F.coalesce("_metrics", F.lit(0))
    failures = F.coalesce("_failed", F.lit(0)) + flat + missing
    return (
        flats.join(wide, KEY, "left")
        .withColumns(
            {
                f"{m}_forecast_generated": F.when(F.col(f"{m}_val").isNull(), 0).otherwise(1)
                for m in METRICS
            }
        )
        .withColumn("status", F.when(failures > 0, "Failed").otherwise("Success"))
        .withColumn("warning", F.coalesce("warning", F.lit(0)))
        .drop("_failed", "_metrics")
    )


def document_status(flats: DataFrame, checks: DataFrame) -> DataFrame:
    return alert_rows(flats, checks).select(*KEY, "status", "warning")


def _equals(suffix: str, value: int, metrics: list[str] = METRICS) -> dict[str, Column]:
    return {m: F.col(f"{m}_{suffix}") == value for m in metrics}


def alert_summary(alerts: DataFrame, kind: str) -> DataFrame:
    """Stores per date with each flag: ``flat``, ``zero`` or ``limits``."""
    if kind == "flat":
        flags = _equals("flat", 1)
    elif kind == "zero":
        flags = _equals("generated_successfully", 0)
    else:
        flags = {}
        for m in METRICS:
            flags[f"{m}_over"] = F.col(f"{m}_greater_than_15_max") == 1
            flags[f"{m}_under"] = F.col(f"{m}_less_than_90_min") == 1
    return flag_counts(alerts, flags)


def reported(summary: DataFrame, total_stores: int | None = None, percent: float = 2.0):
    """Rows to show: any count above 0, or above a share of all stores."""
    counts = [c for c in summary.columns if c != DAY]
    shown = F.lit(False)
    for c in counts:
        if total_stores is None:
            shown = shown | (F.col(c) != 0)
        else:
            shown = shown | (F.col(c).cast("double") / total_stores * 100 > percent)
    return summary.where(shown)


def missing_documents(
    stores: DataFrame, dates: list[date], delivered: DataFrame, sat_off: DataFrame
) -> DataFrame:
    """Expected store-date pairs without a document, Sundays never expected."""
    open_days = [d for d in dates if d.weekday() != 6]
    expected = with_saturday_off(scaffold(stores.select(LOC).distinct(), open_days), sat_off)
    wanted = expected.where(~(F.col("_sat_off") & (F.weekday(DAY) == 5))).select(*KEY)
    return wanted.join(delivered.select(*KEY).distinct(), KEY, "left_anti")


def active_only(
    missing: DataFrame, daily: DataFrame, as_of: date, days: int = 58, at_least: int = 3
) -> DataFrame:
    """Missing pairs of stores that lately sold on that weekday."""
    since = F.lit(as_of - timedelta(days=days))
    active = frequent_weekdays(daily, since, at_least).select(LOC, "weekday")
    return (
        missing.withColumn("weekday", F.weekday(DAY))
        .join(active, [LOC, "weekday"], "left_semi")
        .select(pad_store(F.col(LOC)).alias("store_number"), DAY)
    )


def split_by_threshold(missing: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Pairs on dates with more missing stores than the threshold, and the rest."""
    crowded = missing_per_date(missing).where(F.col("missing_count") > threshold).select(DAY)
    return missing.join(crowded, DAY, "left_semi"), missing.join(crowded, DAY, "left_anti")

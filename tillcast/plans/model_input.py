"""Input series of the scoring step: past actuals and future calendar days."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators.predicates import closed_flag
from tillcast.operators.snapshot import not_before
from tillcast.plans.preparation import FEATURES

LOC = "location_num"
DELAY = 2  # days between the newest actuals and the run date


def last_good_date(
    metric_checks: DataFrame,
    item_checks: DataFrame,
    final: DataFrame,
    as_of: date,
    window: int = 61,
) -> DataFrame:
    """Newest date for which both metric families passed in the same run.

    Falls back to the newest prepared date of the store.
    """

    def passed(checks: DataFrame) -> DataFrame:
        recent = F.col("generation_date") > F.lit(as_of - timedelta(days=window))
        return checks.where((F.col("dailyqc") == 1) & recent)

    runs = passed(item_checks).select(LOC, "generation_date").distinct()
    good = (
        passed(metric_checks)
        .join(runs, [LOC, "generation_date"], "left_semi")
        .groupBy(LOC)
        .agg(F.max("business_date_max").alias("_good"))
    )
    newest = final.groupBy(LOC).agg(F.max("business_date").alias("_final"))
    return newest.join(good, LOC, "full_outer").select(
        LOC, F.coalesce("_good", "_final").alias("max_date")
    )


def _calendar_rows(
    series: DataFrame, calendar: DataFrame, first, last, columns: list[str]
) -> DataFrame:
    """Every series on every calendar date of its own closed range."""
    days = series.where(first <= last).withColumn(
        "business_date", F.explode(F.sequence(first, last))
    )
    return days.join(calendar.select("business_date", *columns).distinct(), "business_date")


def model_input(
    final: DataFrame,
    series: DataFrame,
    calendar: DataFrame,
    last_good: DataFrame,
    sat_off: DataFrame,
    measures: list[str],
    as_of: date,
    prepared_on: DataFrame,
    past: int = 56,
    future: int = 32,
) -> DataFrame:
    """Past rows after ``last_good - past`` up to two days ago, then the future.

    Actuals count up to the store's last good date; later past days and all
    future days are 0.  ``series`` lists the keys: a store, or a store and
    product.  ``prepared_on`` is a check table whose newest version is stamped.
    ``last_good`` is used several times: a stored control table.
    """
    keys = series.columns
    today = F.lit(as_of - timedelta(days=DELAY))
    dated = series.distinct().join(last_good.select(LOC, "max_date"), LOC)
    history = _calendar_rows(
        dated, calendar, F.date_sub("max_date", past - 1), today, FEATURES
    )
    starts = last_good.select(F.date_sub("max_date", past - 1).alias("_start"))
    # Copies are dropped here, before the grid is built, which has no others.
    actuals = not_before(
        final.select(*keys, "business_date", *measures), "business_date", starts, "_start"
    ).distinct()
    # Only days up to the last good date may match, so the bound is part of the key.
    bounded = (
        actuals.join(last_good.select(LOC, "max_date"), LOC)
        .where(
            (F.col("business_date") <= F.col("max_date"))
            & (F.col("business_date") > F.date_sub("max_date", past))
        )
        .drop("max_date")
    )
    zero = F.lit(0).cast("decimal(18,2)")
    observed = (
        history.drop("max_date")
        .join(bounded, [*keys, "business_date"], "left")
        .withColumns({m: F.coalesce(m, zero) for m in measures})
    )
    ahead = closed_flag(
        _calendar_rows(
            series.distinct(), calendar, F.date_add(today, 1), F.date_add(today, future), FEATURES
        ),
        sat_off,
    ).withColumns({m: zero for m in measures})
    stamp = prepared_on.agg(F.max("generation_date")).scalar()
    return (
        observed.unionByName(ahead).withColumn("dataprep_generation_date", stamp)
    )


def modelled_pairs(final_items: DataFrame, combinations: DataFrame) -> DataFrame:
    """Store-product pairs that have a model and prepared facts."""
    pairs = final_items.select(LOC, "product").distinct()
    return pairs.join(combinations.select(LOC, "product").distinct(), [LOC, "product"], "left_semi")

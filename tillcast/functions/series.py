"""Array expressions over one short time series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def median_of(values: Column, size: int) -> Column:
    """Median of a numeric array of a known size."""
    ordered = F.array_sort(values)
    middle = size // 2
    if size % 2:
        return F.element_at(ordered, middle + 1)
    return (F.element_at(ordered, middle) + F.element_at(ordered, middle + 1)) / F.lit(2.0)


def trailing_days(
    df: DataFrame, keys: list[str], value: str, days: int = 30, day: str = "business_date"
) -> DataFrame:
    """Per key an array ``history`` of its last ``days`` calendar days, missing days 0.

    The last day is the key's newest.  A day's rows are summed before the list is built, so
    it has at most ``days`` entries; a key with a shorter history keeps its place.
    """
    last = df.groupBy(*keys).agg(F.max(day).alias("_last"))
    recent = df.join(last, keys).where(F.col(day) > F.date_sub("_last", days))
    daily = recent.groupBy(*keys, "_last", day).agg(F.sum(value).cast("double").alias("_x"))
    by_day = daily.groupBy(*keys, "_last").agg(
        F.map_from_entries(F.collect_list(F.struct(day, "_x"))).alias("_by_day")
    )
    dates = F.sequence(F.date_sub("_last", days - 1), F.col("_last"))
    filled = F.transform(dates, lambda d: F.coalesce(F.col("_by_day")[d], F.lit(0.0)))
    return by_day.select(*keys, filled.alias("history"))


def recursive_median(history: Column, window: int = 30, steps: int = 34) -> Column:
    """The history followed by ``steps`` predictions.

    Each prediction is the median of the ``window`` values before it, earlier
    predictions included, so the fold runs inside the row: no UDF, no shuffle.
    """
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        history.cast("array<double>"),
        lambda seen, _: F.concat(
            seen,
            F.array(F.greatest(median_of(F.slice(seen, -window, window), window), F.lit(0.0))),
        ),
    )

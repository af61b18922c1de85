"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dec2(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def clamp(value: Column) -> Column:
    """Negative predictions become 0; NULL stays NULL."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def dsum(value: Column, cast_first: bool) -> Column:
    """Sum as decimal(18,2); the cast before or after the sum rounds differently."""
    return dec2(F.sum(dec2(value))) if cast_first else dec2(F.sum(value))


def avg_or(value: Column, default: float) -> Column:
    return F.coalesce(F.avg(value), F.lit(default))


def planned_mean(value: Column, planned: Column) -> Column:
    """Sum over the planned number of points, so missing points count as 0."""
    return F.when(planned > 0, F.sum(value).cast("double") / planned).otherwise(F.lit(0.0))


def safe_ratio(value: Column, base: Column) -> Column:
    """Relative change of value against base; 0 where base is 0."""
    return F.when(base != 0, (value - base) / base).otherwise(F.lit(0.0))


def uplift(average: Column, trend: Column, smoothing: Column) -> Column:
    return average + average * trend * smoothing


def limit_band(median: Column, share: float = 0.35) -> tuple[Column, Column]:
    return median - F.lit(share) * median, median + F.lit(share) * median


def robust_scale(value: Column, median: Column, iqr: Column) -> Column:
    return F.when(iqr != 0, (value - median) / iqr).otherwise(value)


def robust_unscale(value: Column, median: Column, iqr: Column) -> Column:
    return F.when(iqr != 0, value * iqr + median).otherwise(value)

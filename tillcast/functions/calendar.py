"""Date and time-of-day expressions.  All are built-in column expressions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The 96 quarter-hours of a day, 00:00:00 .. 23:45:00.
QUARTER_HOURS = [f"{m // 60:02d}:{m % 60:02d}:00" for m in range(0, 24 * 60, 15)]

# Days after the run date covered by each horizon (fixed values).
HORIZONS = {"short": (16, 19), "long": (21, 24), "redundancy": (25, 29)}


def horizon_dates(as_of: date, horizon: str) -> list[date]:
    first, last = HORIZONS[horizon]
    return [as_of + timedelta(days=n) for n in range(first, last + 1)]


def quarter_hours() -> Column:
    """Array of the 96 interval starts; explode it instead of a cross join."""
    return F.array(*[F.lit(t) for t in QUARTER_HOURS])


def date_array(dates: list[date]) -> Column:
    return F.array(*[F.lit(d) for d in dates])


def time_grid(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(quarter_hours()).alias("interval"))


def dow_sun1(day: Column) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(day)


def dow_mon0(day: Column) -> Column:
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(day)


def dow_iso(day: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(day) + F.lit(1)


def is_closed_holiday(day: Column) -> Column:
    """Fourth Thursday of November, or December 25."""
    thanksgiving = (
        (F.month(day) == 11) & F.dayofmonth(day).between(22, 28) & (F.dayofweek(day) == 5)
    )
    christmas = (F.month(day) == 12) & (F.dayofmonth(day) == 25)
    return thanksgiving | christmas


def last_year_date(day: Column) -> Column:
    """The day of last year that the delivery compares with.

    Normally 364 days back.  Around a year divisible by 400 the published rule
    is one day later in two stretches; delivered numbers depend on it, so it
    is kept.
    """
    year = F.year(day)

    def century_leap(y: Column) -> Column:
        return y % 400 == 0

    def plain_leap(y: Column) -> Column:
        return (y % 4 == 0) & (y % 100 != 0)

    after_february_28 = (F.month(day) > 2) | ((F.month(day) == 2) & (F.dayofmonth(day) == 29))
    two_days = (
        century_leap(year)
        | century_leap(year - 1)
        | (plain_leap(year) & after_february_28)
        | (plain_leap(year - 1) & ~after_february_28)
    )
    return F.date_add(F.add_months(day, -12), F.when(two_days, 2).otherwise(1))


def fiscal_last_year(day: Column, lag: int = 364) -> Column:
    return F.date_sub(day, lag)


def time_of_day(wall_clock: Column) -> Column:
    """HH:mm:ss out of a wall-clock timestamp or its text."""
    return F.substring(wall_clock.cast("string"), 12, 8)


def interval_start(day: Column, time: Column) -> Column:
    return F.concat_ws("T", day.cast("string"), time)


def day_start(day: Column) -> Column:
    return interval_start(day, F.lit("00:00:00"))


def us_date(day: Column) -> Column:
    return F.date_format(day, "MM-dd-yyyy")


def parse_us_date(text: Column) -> Column:
    return F.to_date(text, "MM-dd-yyyy")


def business_today(instant: Column, zone: str = "America/New_York") -> Column:
    """Calendar date of a UTC instant in the business zone."""
    return F.to_date(F.from_utc_timestamp(instant, zone))

"""Row predicates, masks, flags and status rules."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.calendar import (
    HORIZONS,
    date_array,
    dow_iso,
    dow_mon0,
    dow_sun1,
    is_closed_holiday,
)
from tillcast.functions.numeric import clamp
from tillcast.functions.text import pad_store, setting_smoothing, setting_weeks
from tillcast.operators.snapshot import latest_snapshot

LOC = "location_num"
NO_DATE = date(1901, 1, 1)  # fixed value: "no date" in the store table
REGULAR_DAY = "Regular-day"  # fixed value: holiday name of an ordinary day


def with_saturday_off(df: DataFrame, sat_off: DataFrame) -> DataFrame:
    """Adds the boolean ``_sat_off``."""
    listed = sat_off.select(LOC).distinct().withColumn("_sat_off", F.lit(True))
    return df.join(listed, LOC, "left").withColumn(
        "_sat_off", F.coalesce("_sat_off", F.lit(False))
    )


def closed_day(day: Column, sat_off: Column) -> Column:
    return (dow_sun1(day) == 1) | (sat_off & (dow_sun1(day) == 7))


def mask_closed(
    df: DataFrame, sat_off: DataFrame, cols: list[str], day: str = "business_date"
) -> DataFrame:
    """Sets the columns to 0 on Sundays, and on Saturdays of saturday-off stores."""
    flagged = with_saturday_off(df, sat_off)
    closed = closed_day(F.col(day), F.col("_sat_off"))
    masked = {c: F.when(closed, F.lit(0)).otherwise(F.col(c)) for c in cols}
    return flagged.withColumns(masked).drop("_sat_off")


def closed_flag(df: DataFrame, sat_off: DataFrame, name: str = "sunday") -> DataFrame:
    """Saturday-off stores: 1 on ISO days 6 and 7; others the calendar flag."""
    flagged = with_saturday_off(df, sat_off)
    weekend = F.col("_sat_off") & F.col("dayofweek").isin(6, 7)
    return flagged.withColumn(name, F.when(weekend, F.lit(1)).otherwise(F.col("sunday"))).drop(
        "_sat_off"
    )


def special_days(calendar: DataFrame) -> DataFrame:
    named = F.col("federalholiday_name") != REGULAR_DAY
    return calendar.where(named | (F.col("holiday") == 1)).select("business_date").distinct()


def regular_days(df: DataFrame, calendar: DataFrame, drop_sunday: bool = True) -> DataFrame:
    """Drops holidays and otherwise special dates, and Sundays."""
    kept = df.where(dow_mon0(F.col("business_date")) != 6) if drop_sunday else df
    return kept.join(special_days(calendar), "business_date", "left_anti")


def operable_dates(stores: DataFrame, dates: list[date], sat_off: DataFrame) -> DataFrame:
    """Pairs of store and prediction date on which the store is open."""
    pairs = with_saturday_off(stores.select(LOC).distinct(), sat_off).withColumn(
        "prediction_date", F.explode(date_array(dates))
    )
    day = F.col("prediction_date")
    shut = closed_day(day, F.col("_sat_off")) | is_closed_holiday(day)
    return pairs.where(~shut).drop("_sat_off")


def drop_all_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drops rows whose measures are all exactly 0; a NULL measure keeps the row."""
    all_zero = F.lit(True)
    for c in cols:
        all_zero = all_zero & (F.col(c) == 0)
    return df.where(~F.coalesce(all_zero, F.lit(False)))


def zero_fill(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(c, F.lit(0)) for c in cols})


def clamp_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: clamp(F.col(c)) for c in cols})


def _known(actual: str, projected: str) -> Column:
    return F.when(F.col(actual) == F.lit(NO_DATE), F.col(projected)).otherwise(F.col(actual))


def store_status(locations: DataFrame, as_of: date) -> DataFrame:
    """1 open, 99 closed for remodelling, 0 reopened lately, 9999 anything else.

    The actual date counts unless it is the sentinel, then the projected one.
    A store reads as fully open 25 days after reopening and as closed until 20
    days before; within 45 days of reopening it is ramping up.  ``period`` is
    the day a ramping store closed, else the sentinel.
    """
    today, sentinel = F.lit(as_of), F.lit(NO_DATE)
    close = _known("remodelclosedate", "remodelprojectedclosedate")
    reopen = _known("remodelreopendate", "remodelprojectedreopendate")
    no_projection = F.col("remodelclosedate").isNotNull() & (
        F.col("remodelprojectedclosedate") == sentinel
    )
    # An actual close date always counts as "set", the sentinel included, so a
    # missing projection alone makes the store open.
    is_open = no_projection | (close > today) | (reopen < F.lit(as_of - timedelta(days=25)))
    is_closed = (close <= today) & (today < F.date_sub(reopen, 20))
    is_ramping = reopen >= F.lit(as_of - timedelta(days=45))
    status = F.when(is_open, 1).when(is_closed, 99).when(is_ramping, 0).otherwise(9999)
    return locations.withColumn("status", status).withColumn(
        "period", F.when(F.col("status") == 0, close).otherwise(sentinel)
    )


def forecastable(
    statuses: DataFrame,
    location_list: DataFrame,
    n: int | None = None,
    forecast_type: str = "LSTM",
) -> DataFrame:
    """Status list of the modelled stores, limited to ``status <= n`` if given.

    A closed store whose actual close date is the sentinel in the newest
    snapshot of the store table is run as open.
    """
    modelled = location_list.where(F.col("forecast_type") == forecast_type).select(LOC).distinct()
    newest = latest_snapshot(statuses).select(LOC, F.col("remodelclosedate").alias("_close"))
    override = (F.col("status") == 99) & (F.col("_close") == F.lit(NO_DATE))
    listed = (
        statuses.join(modelled, LOC, "left_semi")
        .join(newest.distinct(), LOC, "left")
        .select(
            pad_store(F.col(LOC)).alias("store_number"),
            F.when(override, F.lit(1)).otherwise(F.col("status")).alias("status"),
            "period",
        )
        .distinct()
    )
    return listed if n is None else listed.where(F.col("status") <= n)


def parse_settings(
    stores: DataFrame, settings: DataFrame, weeks: int = 5, smoothing: float = 0.0
) -> DataFrame:
    """Lookup weeks and smoothing of every store, defaults where nothing is set."""
    code = F.col("naming_conv")
    return (
        stores.select(LOC)
        .distinct()
        .join(settings.select(LOC, "naming_conv"), LOC, "left")
        .select(
            LOC,
            setting_weeks(code, weeks).alias("lookup_weeks"),
            setting_smoothing(code, smoothing).alias("smoothing_fact"),
        )
    )


def horizon_of(day: Column, as_of: date) -> Column:
    ahead = F.datediff(day, F.lit(as_of))
    name = F.lit(None).cast("string")
    for horizon, (first, last) in HORIZONS.items():
        name = F.when(ahead.between(first, last), F.lit(horizon)).otherwise(name)
    return name


def split_horizons(df: DataFrame, as_of: date, day: str = "business_date") -> DataFrame:
    """Labels every row with its horizon and drops dates outside all of them."""
    return df.withColumn("horizon", horizon_of(F.col(day), as_of)).where(
        F.col("horizon").isNotNull()
    )


def holidays(calendar: DataFrame, as_of: date) -> DataFrame:
    this_year = F.year("business_date") == as_of.year
    return calendar.where((F.col("holiday") == 1) & this_year).select("business_date").distinct()


def min_history(df: DataFrame, keys: list[str], rows: int = 57) -> DataFrame:
    """Keeps series with at least ``rows`` rows."""
    long_enough = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= rows)
    return df.join(long_enough, keys, "left_semi")


def freshness(
    df: DataFrame, keys: list[str], as_of: date, days_ahead: int = 32, limit: int = 6
) -> DataFrame:
    """Per series the first date to forecast and whether it is too old to score."""
    first = F.date_sub(F.max("business_date"), days_ahead - 1)
    return (
        df.groupBy(*keys)
        .agg(first.alias("first_forecast_date"))
        .withColumn(
            "forecast_zero",
            F.when(F.datediff(F.lit(as_of), "first_forecast_date") > limit, 1).otherwise(0),
        )
    )


def zero_holidays(df: DataFrame, metric: str, closed_days: bool = False) -> DataFrame:
    """Metric 0 on holidays; with ``closed_days`` on Sundays too."""
    closed = F.col("holiday") == 1
    if closed_days:
        closed = closed | (F.col("sunday") == 1)
    return df.withColumn(metric, F.when(closed, F.lit(0)).otherwise(F.col(metric)))


def regular_history(df: DataFrame, sat_off: DataFrame) -> DataFrame:
    """Adds ``_regular``: an open day without any special-day flag."""
    # The special-day flags of the calendar.
    flags = [
        "aroundchristmas",
        "onedaypriorchristmas_and_new_year",
        "blackfridaycheck",
        "holiday",
        "aroundthanksgiving",
        "federalholiday",
    ]
    ordinary = F.col("dayofweek") != 7
    for flag in flags:
        ordinary = ordinary & (F.col(flag) == 0)
    off = F.col("_sat_off") & (F.col("dayofweek") == 6)
    return (
        with_saturday_off(df, sat_off).withColumn("_regular", ordinary & ~off).drop("_sat_off")
    )


def first_rows(df: DataFrame, keys: list[str], n: int = 56) -> DataFrame:
    """Adds ``_row`` (1-based, by date) and ``_head`` for the first ``n`` rows."""
    order = Window.partitionBy(*keys).orderBy("business_date")
    return df.withColumn("_row", F.row_number().over(order)).withColumn(
        "_head", F.col("_row") <= n
    )


def iso_weekday(df: DataFrame) -> DataFrame:
    return df.withColumn("dayofweek", dow_iso(F.col("business_date")))


def contract_projection(
    df: DataFrame, columns: dict[str, str], as_text: list[str] | None = None
) -> DataFrame:
    """Selects source columns under their contract names, in contract order."""
    texts = set(as_text or [])
    return df.select(
        [
            (F.col(src).cast("string") if name in texts else F.col(src)).alias(name)
            for name, src in columns.items()
        ]
    )

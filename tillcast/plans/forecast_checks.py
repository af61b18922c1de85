"""Checks of the produced forecasts and the store lists drawn from them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.calendar import HORIZONS, horizon_dates, is_closed_holiday
from tillcast.functions.text import pad_store
from tillcast.operators.aggregates import all_passed, distinct_days
from tillcast.operators.joins import not_in, scaffold
from tillcast.operators.predicates import closed_day, with_saturday_off
from tillcast.operators.sets import union_all
from tillcast.operators.snapshot import GENERATION, current, latest_snapshot

LOC = "location_num"
DAY = "business_date"


def _differs(a: Column, b: Column) -> Column:
    return F.coalesce(a != b, F.lit(False))


def _newest(df: DataFrame, control: DataFrame | None = None) -> DataFrame:
    return latest_snapshot(df, keys=[LOC], control=control)


def _pruned(df: DataFrame, control: DataFrame | None) -> DataFrame:
    """The rows to look for newest versions in: all, or those a control table lists."""
    known = df.where(F.col(LOC).isNotNull() & F.col(GENERATION).isNotNull())
    return known if control is None else current(known, control, GENERATION, [LOC])


def _bounded_days(per_day: DataFrame) -> DataFrame:
    """Days of each store's newest version with its first and last day, from rows per day."""
    store = Window.partitionBy(LOC)  # a few dates each
    newest = per_day.withColumn("_newest", F.max(GENERATION).over(store))
    newest = newest.where(F.col(GENERATION) == F.col("_newest")).drop("_newest")
    return newest.withColumns({"_low": F.min(DAY).over(store), "_high": F.max(DAY).over(store)})


def run_dates(short_daily: DataFrame) -> DataFrame:
    """Run date of a store: newest version of its short daily sales forecast."""
    return short_daily.groupBy(LOC).agg(F.max(GENERATION).alias("run_date"))


def forecast_check_metrics(
    sales: DataFrame,
    trans: DataFrame,
    runs: DataFrame,
    horizon: str,
    as_of: date,
    rows_per_day: int = 1,
    redundancy: bool = False,
    versions: tuple[DataFrame | None, DataFrame | None] = (None, None),
) -> DataFrame:
    """First and last date and rows per day of both metric forecasts.

    A date found only on the transaction side reports NULL store and date.
    The redundancy flavour joins inner and takes both bounds from sales.  Each table is
    read once and counted per day; bounds and runs come from these few rows.  ``versions``
    are the control tables of both.
    """
    first, last = HORIZONS[horizon]
    key = [LOC, GENERATION, DAY]

    def counted(df: DataFrame, control: DataFrame | None, name: str) -> DataFrame:
        return _pruned(df, control).groupBy(*key).agg(F.count(F.lit(1)).alias(name))

    trans_versions = versions[1]
    if trans_versions is not None:  # transactions are also read at the version of the sales
        trans_versions = trans_versions.unionByName(versions[0]).distinct()
    both = counted(sales, versions[0], "sales_rows").unionByName(
        counted(trans, trans_versions, "trans_rows"), allowMissingColumns=True
    )
    store = Window.partitionBy(LOC)  # a few dates each
    days = (
        both.groupBy(*key)
        .agg(F.max("sales_rows").alias("sales_rows"), F.max("trans_rows").alias("trans_rows"))
        .withColumn("_in_sales", F.col("sales_rows").isNotNull())
        .withColumns(
            {
                "_sales_run": F.max(F.when(F.col("_in_sales"), F.col(GENERATION))).over(store),
                "_trans_run": F.max(
                    F.when(F.col("trans_rows").isNotNull(), F.col(GENERATION))
                ).over(store),
            }
        )
    )
    of_run = F.when(F.col("_in_sales") & (F.col(GENERATION) == F.col("_sales_run")), F.col(DAY))
    of_trans = F.col("trans_rows").isNotNull() & (F.col(GENERATION) == F.col("_trans_run"))
    last_day = of_run if redundancy else F.when(of_trans, F.col(DAY))
    days = days.withColumns({"_low": F.min(of_run).over(store), "_high": F.max(last_day).over(store)})
    compared = days.where(F.col(GENERATION) == F.col("_sales_run"))
    if redundancy:
        compared = compared.where(F.col("_in_sales") & F.col("trans_rows").isNotNull())
    joined = compared.join(runs, LOC, "left")
    wrong = (
        _differs(F.col("_low"), F.date_add("run_date", first))
        | _differs(F.col("_high"), F.date_add("run_date", last))
        | _differs(F.col("trans_rows"), F.lit(rows_per_day))
        | _differs(F.col("sales_rows"), F.lit(rows_per_day))
    )

    def of_sales(name: str) -> Column:
        return F.when(F.col("_in_sales"), F.col(name))

    return joined.select(
        of_sales(GENERATION).alias("forecast_generation_date"),
        of_sales(DAY).alias(DAY),
        of_sales(LOC).alias(LOC),
        F.lit(as_of).alias("generation_date"),
        F.when(wrong, 0).otherwise(1).alias("forecast_qc"),
    ).distinct()


def forecast_check_15min(
    intervals: DataFrame,
    runs: DataFrame,
    horizon: str,
    as_of: date,
    rows_per_day: int = 96,
    versions: DataFrame | None = None,
) -> DataFrame:
    """Same for one table that holds both metrics."""
    first, last = HORIZONS[horizon]
    counted = _pruned(intervals, versions).groupBy(LOC, GENERATION, DAY)
    per_day = _bounded_days(counted.agg(F.count(F.lit(1)).alias("_rows")))
    wrong = (
        _differs(F.col("_low"), F.date_add("run_date", first))
        | _differs(F.col("_high"), F.date_add("run_date", last))
        | _differs(F.col("_rows"), F.lit(rows_per_day))
    )
    return (
        per_day.join(runs, LOC, "left")
        .select(
            F.col(GENERATION).alias("forecast_generation_date"),
            DAY,
            LOC,
            F.lit(as_of).alias("generation_date"),
            F.when(wrong, 0).otherwise(1).alias("forecast_qc"),
        )
    )


def forecast_check_items(
    items: DataFrame,
    expected: DataFrame,
    runs: DataFrame,
    horizon: str,
    as_of: date,
    rows_per_item: int = 1,
    versions: DataFrame | None = None,
) -> DataFrame:
    """Enough distinct items per date, the right dates and rows per item."""
    first, last = HORIZONS[horizon]
    per_day = _newest(items, versions).groupBy(LOC, GENERATION, DAY).agg(
        F.countDistinct("item_id").alias("actual_items"), F.count(F.lit(1)).alias("_rows")
    )
    per_day = _bounded_days(per_day)
    wanted = expected.select(LOC, F.col("products").alias("expected_items")).distinct()
    wrong = (
        F.coalesce(F.col("actual_items") < F.col("expected_items"), F.lit(False))
        | _differs(F.col("_low"), F.date_add("run_date", first))
        | _differs(F.col("_high"), F.date_add("run_date", last))
        | _differs(F.col("actual_items") * rows_per_item, F.col("_rows"))
    )
    return (
        per_day.join(runs, LOC, "left")
        .join(wanted, LOC, "left")
        .select(
            F.col(GENERATION).alias("forecast_generation_date"),
            DAY,
            "expected_items",
            "actual_items",
            LOC,
            F.lit(as_of).alias("generation_date"),
            F.when(wrong, 0).otherwise(1).alias("forecast_qc"),
        )
    )


def forecast_check_chain(
    sales: DataFrame, trans: DataFrame, expected_locations: DataFrame, horizon: str, as_of: date
) -> DataFrame:
    """All stores at once: stores and rows per date in both metrics."""
    first, last = horizon_dates(as_of, horizon)[0], horizon_dates(as_of, horizon)[-1]
    newest = latest_snapshot(sales)
    version = sales.agg(F.max(GENERATION)).scalar()
    a = newest.groupBy(DAY, GENERATION).agg(
        F.countDistinct(LOC).alias("actual_locations"), F.count(F.lit(1)).alias("row_count")
    )
    c = (
        trans.where(F.col(GENERATION) == version)
        .groupBy(DAY, GENERATION)
        .agg(F.countDistinct(LOC).alias("_locations"), F.count(F.lit(1)).alias("_rows"))
    )
    expected = expected_locations.agg(F.max("expected_locations")).scalar()
    low, high = newest.agg(F.min(DAY)).scalar(), newest.agg(F.max(DAY)).scalar()
    wrong = (
        _differs(F.col("row_count"), F.col("_rows"))
        | F.coalesce(F.col("actual_locations") < F.col("expected_locations"), F.lit(False))
        | _differs(F.col("_locations"), F.col("actual_locations"))
        | _differs(low, F.lit(first))
        | _differs(high, F.lit(last))
    )
    return (
        a.join(c, [DAY, GENERATION])
        .withColumn("expected_locations", expected)
        .select(
            F.col(GENERATION).alias("forecast_generation_date"),
            DAY,
            "expected_locations",
            "actual_locations",
            "row_count",
            F.lit(as_of).alias("generation_date"),
            F.when(wrong, 0).otherwise(1).alias("forecast_qc"),
        )
    )


def forecast_check_chain_items(
    items: DataFrame,
    expected_items: DataFrame,
    expected_locations: DataFrame,
    horizon: str,
    as_of: date,
) -> DataFrame:
    """The item form: distinct items and stores per date."""
    first, last = horizon_dates(as_of, horizon)[0], horizon_dates(as_of, horizon)[-1]
    newest = latest_snapshot(items)
    low, high = newest.agg(F.min(DAY)).scalar(), newest.agg(F.max(DAY)).scalar()
    counts = (
        newest.groupBy(DAY, GENERATION)
        .agg(
            F.countDistinct("item_id").alias("actual_items"),
            F.countDistinct(LOC).alias("actual_locations"),
        )
        .withColumn("expected_items", expected_items.agg(F.count(F.lit(1))).scalar())
        .withColumn(
            "expected_locations", expected_locations.agg(F.max("expected_locations")).scalar()
        )
    )
    wrong = (
        F.coalesce(F.col("actual_items") < F.col("expected_items"), F.lit(False))
        | F.coalesce(F.col("actual_locations") < F.col("expected_locations"), F.lit(False))
        | _differs(low, F.lit(first))
        | _differs(high, F.lit(last))
    )
    return counts.select(
        F.col(GENERATION).alias("forecast_generation_date"),
        DAY,
        "expected_locations",
        "expected_items",
        "actual_items",
        "actual_locations",
        F.lit(as_of).alias("generation_date"),
        F.when(wrong, 0).otherwise(1).alias("forecast_qc"),
    )


def baseline_check(
    stores: DataFrame, dates: DataFrame, trend: DataFrame, sat_off: DataFrame, as_of: date
) -> DataFrame:
    """Control tables of the baseline, per store and prediction date.

    The history days must fit the divisor and the lookback, and exactly one
    trend must exist.  Missing days pass, a missing trend fails.
    """
    wanted = horizon_dates(as_of, "short") + horizon_dates(as_of, "long")
    day = F.col("prediction_date")
    shut = closed_day(day, F.col("_sat_off")) | is_closed_holiday(day)
    days_ok = (
        (F.col("row_count") <= F.col("lookup_weeks") - 3)
        & (F.col("row_count") == F.col("forecast_avg_dr"))
        & day.isin(*wanted)
        & ~shut
    )
    days = with_saturday_off(distinct_days(dates), sat_off).select(
        LOC, "prediction_date", days_ok.alias("_dates")
    )
    trends = (
        trend.groupBy(LOC, "prediction_date")
        .agg(F.count("trend").alias("_n"))
        .select(LOC, "prediction_date", ((F.col("_n") == 1) & day.isin(*wanted)).alias("_trend"))
    )
    grid = scaffold(stores.select(LOC).distinct(), wanted).withColumnRenamed(
        DAY, "prediction_date"
    )
    flags = (
        grid.join(days, [LOC, "prediction_date"], "left")
        .join(trends, [LOC, "prediction_date"], "left")
        .withColumns(
            {
                "dates_qc": F.coalesce("_dates", F.lit(True)).cast("int"),
                "trend_qc": F.coalesce("_trend", F.lit(False)).cast("int"),
            }
        )
    )
    return flags.select(
        LOC,
        F.col("prediction_date").alias(DAY),
        "dates_qc",
        "trend_qc",
        F.least("dates_qc", "trend_qc").alias("forecast_qc"),
        F.lit(as_of).alias("generation_date"),
    )


def baseline_verdict(checks: DataFrame) -> DataFrame:
    return all_passed(checks)


def _flagged(tables: list[DataFrame], value: int, null_as_zero: bool) -> list[DataFrame]:
    store = F.coalesce(LOC, F.lit(0)) if null_as_zero else F.col(LOC)
    return [
        latest_snapshot(t).where(F.col("forecast_qc") == value).select(store.alias(LOC)).distinct()
        for t in tables
    ]


def failed_stores(item_checks: list[DataFrame], metric_checks: list[DataFrame]) -> DataFrame:
    """Stores failing any newest check; a NULL store of a metric check is store 0."""
    return union_all(
        *_flagged(item_checks, 0, False), *_flagged(metric_checks, 0, True)
    ).distinct()


def passed_stores(
    item_checks: list[DataFrame],
    metric_checks: list[DataFrame],
    modelled: DataFrame | None = None,
) -> DataFrame:
    """Padded stores passing in items and in metrics and failing nowhere.

    One pass over the check rows decides all three conditions per store.  The
    failing stores act as a NOT IN list: a NULL store failing an item check
    empties the result, and one failing a metric check counts as store 0.
    ``modelled`` stores are left out too, as the baseline list does.
    """
    qc = F.col("forecast_qc")
    items = [latest_snapshot(t).select(LOC, qc, F.lit("item").alias("_f")) for t in item_checks]
    metrics = [
        latest_snapshot(t).select(
            F.when(qc == 0, F.coalesce(LOC, F.lit(0))).otherwise(F.col(LOC)).alias(LOC),
            qc,
            F.lit("metric").alias("_f"),
        )
        for t in metric_checks
    ]
    per_store = (
        union_all(*items, *metrics)
        .groupBy(LOC)
        .agg(
            F.max((F.col("_f") == "item") & (qc == 1)).alias("_items"),
            F.max((F.col("_f") == "metric") & (qc == 1)).alias("_metrics"),
            F.max(qc == 0).alias("_failed"),
        )
    )
    unknown = per_store.where(F.col(LOC).isNull() & F.col("_failed")).agg(F.count(F.lit(1)))
    kept = per_store.where(
        F.col(LOC).isNotNull() & F.col("_items") & F.col("_metrics") & ~F.col("_failed")
    ).where(unknown.scalar() == 0)
    if modelled is not None:
        kept = not_in(kept, LOC, modelled.select(LOC))
    return kept.select(pad_store(F.col(LOC)).alias("store_number"))

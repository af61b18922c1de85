"""Delivered documents: forecast beside last year's actuals, per store and date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.calendar import (
    day_start,
    interval_start,
    last_year_date,
    quarter_hours,
    time_of_day,
)
from tillcast.functions.numeric import dec2
from tillcast.functions.text import pad_store
from tillcast.operators.joins import full_join
from tillcast.operators.predicates import drop_all_zero
from tillcast.operators.snapshot import latest_snapshot, not_before

LOC = "location_num"
DAY = "business_date"
KEY = [LOC, DAY]
FORECAST, DEFERRED = "3", "2"  # fixed values: service types


def delivery_dates(forecast: DataFrame) -> DataFrame:
    """Dates of each store's newest run and the day of last year to compare.

    A few rows per store, used by every part of a document: store them once.
    """
    dates = latest_snapshot(forecast, keys=[LOC]).select(*KEY).distinct()
    return dates.withColumn("ly_date", last_year_date(F.col(DAY)))


def _last_year(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Facts of the compared days under the delivered date."""
    days = dates.select(LOC, F.col(DAY).alias("_day"), F.col("ly_date").alias(DAY))
    recent = not_before(facts, DAY, days, DAY)
    return recent.join(days, KEY).drop(DAY).withColumnRenamed("_day", DAY)


def _newest(forecast: DataFrame, dates: DataFrame) -> DataFrame:
    """Newest version of the forecast for the delivered dates only."""
    return latest_snapshot(forecast.join(dates.select(*KEY), KEY, "left_semi"), keys=KEY)


def _or_zero(name: str) -> Column:
    return dec2(F.coalesce(F.col(name), F.lit(0)))


def doc_header(forecast: DataFrame, final_daily: DataFrame, dates: DataFrame) -> DataFrame:
    totals = _newest(forecast, dates).groupBy(*KEY).agg(
        F.sum("forecast").alias("forecast"), F.sum("forecast_tx").alias("forecast_tx")
    )
    actuals = _last_year(final_daily, dates).select(*KEY, "sales_sub_total", "trans_count")
    return (
        full_join(totals, actuals, KEY)
        .select(
            LOC,
            DAY,
            pad_store(F.col(LOC)).alias("storenumber"),
            day_start(F.col(DAY)).alias("businessday"),
            F.lit("true").alias("readonly"),
            F.lit("Net Sales").alias("forecastbasis"),
            _or_zero("forecast").alias("sales"),
            _or_zero("forecast_tx").alias("transactioncount"),
            _or_zero("sales_sub_total").alias("lastyearsales"),
            _or_zero("trans_count").alias("lastyeartransactioncount"),
        )
        .distinct()
    )


def doc_metrics(forecast: DataFrame, facts_15min: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales and transactions per quarter-hour beside last year's by time of day."""
    keys = [*KEY, "time"]
    ahead = _newest(forecast, dates).select(
        *KEY, F.col("interval_start_time").alias("time"), "forecast", "forecast_tx"
    )
    behind = _last_year(facts_15min, dates).select(
        *KEY, time_of_day(F.col("timequarter")).alias("time"), "sales_sub_total", "trans_count"
    )
    measures = ["forecast", "forecast_tx", "sales_sub_total", "trans_count"]
    return (
        drop_all_zero(full_join(ahead, behind, keys), measures)
        .select(
            *KEY,
            interval_start(F.col(DAY), F.col("time")).alias("intervalstart"),
            F.lit(FORECAST).alias("servicetype"),
            _or_zero("forecast").alias("sales"),
            _or_zero("forecast_tx").alias("transactioncount"),
            _or_zero("sales_sub_total").alias("lastyearsales"),
            _or_zero("trans_count").alias("lastyeartransactioncount"),
        )
        .distinct()
    )


def doc_deferred_metrics(deferred: DataFrame, dates: DataFrame) -> DataFrame:
    """Last year's deferred sales under service type 2; the forecast is 0."""
    rows = drop_all_zero(_last_year(deferred, dates), ["sales_sub_total", "trans_count"])
    return rows.select(
        *KEY,
        interval_start(F.col(DAY), time_of_day(F.col("timequarter"))).alias("intervalstart"),
        F.lit(DEFERRED).alias("servicetype"),
        dec2(F.lit(0)).alias("sales"),
        dec2(F.lit(0)).alias("transactioncount"),
        _or_zero("sales_sub_total").alias("lastyearsales"),
        _or_zero("trans_count").alias("lastyeartransactioncount"),
    )


def _code_intervals(
    forecast: DataFrame, code: str, facts: DataFrame, fact_code: str, amount: str, dates: DataFrame
) -> DataFrame:
    """Forecast and last year per code and quarter-hour.

    Every code forecast for a date in any run gets all 96 intervals; they are
    exploded inside the row, and both sides are joined by equality.
    """
    keys = [*KEY, code, "time"]
    codes = forecast.join(dates.select(*KEY), KEY, "left_semi").select(*KEY, code).distinct()
    grid = codes.withColumn("time", F.explode(quarter_hours()))
    # Facts meet forecast dates only; a fallback's dates reach over all of history.
    compared = dates.join(codes.select(*KEY).distinct(), KEY, "left_semi")
    behind = _last_year(facts, compared).select(
        *KEY,
        F.col(fact_code).alias(code),
        time_of_day(F.col("timequarter")).alias("time"),
        dec2(F.col(amount)).alias("amount"),
    )
    ahead = _newest(forecast, dates).select(
        *KEY, code, F.col("interval_start_time").alias("time"), "forecast"
    )
    joined = (
        grid.join(behind, keys, "left")
        .withColumn("amount", F.coalesce("amount", dec2(F.lit(0))))
        .distinct()
        .join(ahead.distinct(), keys, "left")
    )
    return (
        drop_all_zero(joined, ["forecast", "amount"])
        .select(
            *KEY,
            F.col(code).cast("string").alias("code"),
            interval_start(F.col(DAY), F.col("time")).alias("intervalstart"),
            F.lit(FORECAST).alias("servicetype"),
            _or_zero("forecast").alias("transactioncount"),
            F.col("amount").alias("lastyearcount"),
        )
        .distinct()
    )


def doc_items(forecast: DataFrame, facts_15min: DataFrame, dates: DataFrame) -> DataFrame:
    return _code_intervals(
        forecast, "item_id", facts_15min, "product", "sum_daily_quantity", dates
    )


def doc_ingredients(forecast: DataFrame, facts_15min: DataFrame, dates: DataFrame) -> DataFrame:
    return _code_intervals(
        forecast, "ingredient_id", facts_15min, "ingredient_id", "ingredient_quantity", dates
    )


def doc_deferred_items(deferred: DataFrame, dates: DataFrame) -> DataFrame:
    rows = _last_year(deferred, dates).where(F.col("sum_daily_quantity") != 0)
    return rows.select(
        *KEY,
        F.col("product").cast("string").alias("code"),
        interval_start(F.col(DAY), time_of_day(F.col("timequarter"))).alias("intervalstart"),
        F.lit(DEFERRED).alias("servicetype"),
        dec2(F.lit(0)).alias("transactioncount"),
        dec2(F.col("sum_daily_quantity")).alias("lastyearcount"),
    )


def _texts(names: dict[str, str]) -> list[Column]:
    return [F.col(src).cast("string").alias(name) for name, src in names.items()]


# Contract names of the detail fields, in order.
_METRIC = {
    "IntervalStart": "intervalstart",
    "ServiceType": "servicetype",
    "Sales": "sales",
    "TransactionCount": "transactioncount",
    "LastYearSales": "lastyearsales",
    "LastYearTransactionCount": "lastyeartransactioncount",
}
_COUNTS = {
    "IntervalStart": "intervalstart",
    "ServiceType": "servicetype",
    "TransactionCount": "transactioncount",
    "LastYearCount": "lastyearcount",
}
_HEADER = {
    "StoreNumber": "storenumber",
    "BusinessDay": "businessday",
    "ReadOnly": "readonly",
    "ForecastBasis": "forecastbasis",
    "Sales": "sales",
    "TransactionCount": "transactioncount",
    "LastYearSales": "lastyearsales",
    "LastYearTransactionCount": "lastyeartransactioncount",
}


def _details(rows: DataFrame, fields: dict[str, str], order: list[str], name: str) -> DataFrame:
    """One sorted array per document.

    A document holds 96 rows per code of one store and day, which is what the
    contract delivers; the list grows with the codes, not with history.  The
    sort key leads each element, so the built-in struct order sorts it.
    """
    keys = [c for c in order if c in rows.columns]
    rest = [c for c in fields.values() if c not in keys]
    line = F.struct(*keys, *rest, F.struct(*_texts(fields)).alias("_line"))
    lines = F.array_sort(F.collect_list(line))
    return rows.groupBy(*KEY).agg(F.transform(lines, lambda x: x["_line"]).alias(name))


def build_documents(
    header: DataFrame,
    metrics: DataFrame,
    items: DataFrame,
    ingredients: DataFrame,
    generated_at: str,
    summary: bool = False,
) -> DataFrame:
    """One nested record per store and date of the header.

    The summary twin has empty item arrays.  The flavours (2 weeks, 3 weeks, redundancy,
    fallback) differ in the dates and forecasts that their parts were built from.
    """
    order = ["servicetype", "code", "intervalstart"]
    docs = header.join(_details(metrics, _METRIC, order, "MetricDetail"), KEY, "left")
    for name, rows, code in (
        ("SalesItemDetail", items, "SalesItemCode"),
        ("InventoryItemDetail", ingredients, "ItemCode"),
    ):
        fields = {code: "code", **_COUNTS}
        if summary:
            none = F.array().cast(_array_type(fields))
            docs = docs.withColumn(name, none)
        else:
            nested = _details(rows, fields, order, name)
            docs = docs.join(nested, KEY, "left")
    arrays = ["MetricDetail", "SalesItemDetail", "InventoryItemDetail"]
    kinds = {
        "MetricDetail": _METRIC,
        "SalesItemDetail": {"SalesItemCode": "code", **_COUNTS},
        "InventoryItemDetail": {"ItemCode": "code", **_COUNTS},
    }
    filled = [
        F.coalesce(F.col(a), F.array().cast(_array_type(kinds[a]))).alias(a) for a in arrays
    ]
    return docs.select(
        *KEY,
        F.struct(*_texts(_HEADER), *filled).alias("Forecast"),
        F.lit(generated_at).alias("GenerationDate"),
    )


def _array_type(fields: dict[str, str]) -> str:
    return f"array<struct<{','.join(f'{name}:string' for name in fields)}>>"


def fallback_dates(pairs: DataFrame) -> DataFrame:
    """Delivery dates for an explicit list of store-date pairs."""
    return pairs.select(*KEY).distinct().withColumn("ly_date", last_year_date(F.col(DAY)))


def routed(pairs: DataFrame, by_type: dict[str, DataFrame]) -> DataFrame:
    """Each listed pair's rows out of the forecast table of its ``forecast_type``.

    A pair listed with several types takes the first of them by name.  The tables, which
    have the same columns, are each cut to their own pairs in one equality join; pairs
    that no table holds have no rows here and are documents of last year's facts alone.
    """
    typed = pairs.groupBy(*KEY).agg(F.min("forecast_type").alias("forecast_type"))
    out = None
    for kind, forecast in by_type.items():
        mine = typed.where(F.col("forecast_type") == kind).select(*KEY)
        rows = not_before(forecast, DAY, mine, DAY).join(mine, KEY, "left_semi")
        out = rows if out is None else out.unionByName(rows)
    return out

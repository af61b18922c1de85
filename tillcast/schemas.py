"""Explicit schemas of the domain tables, so that no reader infers one."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_INT, _DATE, _TEXT, _REAL = T.IntegerType(), T.DateType(), T.StringType(), T.DoubleType()
# Wall-clock time in the store: no zone, so no shift when it is read elsewhere.
_WALL = T.TimestampNTZType()

SALES_DAILY = _table(
    ("location_num", _INT),
    ("business_date", _DATE),
    ("sales_sub_total", MONEY),
    ("trans_count", MONEY),
    ("generation_date", _DATE),
)
SALES_15MIN = _table(
    ("location_num", _INT),
    ("business_date", _DATE),
    ("timequarter", _WALL),
    ("sales_sub_total", MONEY),
    ("trans_count", MONEY),
    ("generation_date", _DATE),
)
ITEMS_DAILY = _table(
    ("location_num", _INT),
    ("product", _INT),
    ("business_date", _DATE),
    ("sum_daily_quantity", MONEY),
    ("generation_date", _DATE),
)
ITEMS_15MIN = _table(
    ("location_num", _INT),
    ("product", _INT),
    ("business_date", _DATE),
    ("timequarter", _WALL),
    ("sum_daily_quantity", MONEY),
    ("generation_date", _DATE),
)
RECIPE = _table(
    ("pin", _INT),
    ("ingredient_id", _INT),
    ("ingredient_quantity", _REAL),
    ("unit_of_measure", _TEXT),
    ("generation_date", _DATE),
)
YCF = _table(
    ("location_num", _INT),
    ("ingredient_id", _INT),
    ("ycf", _REAL),
    ("generation_date", _DATE),
)
WEEKDAY_LIMITS = _table(
    ("location_num", _INT),
    ("weekday", _INT),
    ("min_value", _REAL),
    ("max_value", _REAL),
    ("mean", _REAL),
    ("median", _REAL),
    ("std", _REAL),
    ("iqr", _REAL),
)
# A record of an arriving yield-factor file.
YCF_ARRIVAL = _table(
    ("StoreNumber", _TEXT), ("ItemCode", _TEXT), ("YieldCorrectionFactor", _REAL)
)

# Delivery contract (fixed values: the field names and their order).
METRIC_DETAIL = _table(
    ("IntervalStart", _TEXT),
    ("ServiceType", _TEXT),
    ("Sales", _TEXT),
    ("TransactionCount", _TEXT),
    ("LastYearSales", _TEXT),
    ("LastYearTransactionCount", _TEXT),
)
SALES_ITEM_DETAIL = _table(
    ("SalesItemCode", _TEXT),
    ("IntervalStart", _TEXT),
    ("ServiceType", _TEXT),
    ("TransactionCount", _TEXT),
    ("LastYearCount", _TEXT),
)
INVENTORY_ITEM_DETAIL = _table(
    ("ItemCode", _TEXT),
    ("IntervalStart", _TEXT),
    ("ServiceType", _TEXT),
    ("TransactionCount", _TEXT),
    ("LastYearCount", _TEXT),
)
DOCUMENT = _table(
    (
        "Forecast",
        _table(
            ("StoreNumber", _TEXT),
            ("BusinessDay", _TEXT),
            ("ReadOnly", _TEXT),
            ("ForecastBasis", _TEXT),
            ("Sales", _TEXT),
            ("TransactionCount", _TEXT),
            ("LastYearSales", _TEXT),
            ("LastYearTransactionCount", _TEXT),
            ("MetricDetail", T.ArrayType(METRIC_DETAIL)),
            ("SalesItemDetail", T.ArrayType(SALES_ITEM_DETAIL)),
            ("InventoryItemDetail", T.ArrayType(INVENTORY_ITEM_DETAIL)),
        ),
    ),
    ("GenerationDate", _TEXT),
)

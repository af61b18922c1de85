"""Sources, sinks, streams and grouped maps (S, O03, T and X rows).

Each query writes domain tables to a new folder below the shared one, through
the operator under test, and returns what reads back from there.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.checks import DocumentChecks
from catalog.forecasts import _DOC_TEXT, Documents, flat_document, k02
from catalog.registry import query
from catalog.views import AS_OF, DAY, GEN, LOC, Views, days
from catalog.views_sql import AS_OF as TODAY
from tillcast import schemas
from tillcast.functions.calendar import HORIZONS, horizon_dates, is_closed_holiday
from tillcast.functions.text import document_date
from tillcast.operators.predicates import closed_day, with_saturday_off
from tillcast.operators.segments import scan_by_key
from tillcast.session import new_path
from tillcast.sources import documents as D
from tillcast.sources import files as S
from tillcast.streaming import arrivals


def _path(v: Views, name: str) -> str:
    return new_path(v.spark, name)


def _like(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema])


@query("s01_csv_directory_scan", "SELECT * FROM sales_daily")
def _(v):
    path = _path(v, "s01")
    _like(v.sales_daily, schemas.SALES_DAILY).write.option("header", True).csv(path)
    return S.read_csv_dir(v.spark, path, schemas.SALES_DAILY)


@query("s04_store_partitioned_csv", "SELECT *, location_num store_num FROM items_daily")
def _(v):
    path = _path(v, "s04")
    rows = _like(v.items_daily, schemas.ITEMS_DAILY)
    early = F.col(DAY) < F.lit(days(-700))
    S.write_by_store(rows.where(early), path, "overwrite")
    S.write_by_store(rows.where(~early), path, "append")
    declared = T.StructType([*schemas.ITEMS_DAILY, T.StructField("store_num", T.IntegerType())])
    return v.spark.read.schema(declared).option("header", True).csv(path)


@query(
    "s05_single_file_csv",
    "SELECT location_num, prediction_date, smoothing_fact, round(trend, 6) trend, "
    "generation_date FROM baseline_trend",
)
def _(v):
    path = _path(v, "s05")
    trend = k02(v)
    S.write_single(trend, path, [LOC, "prediction_date"])
    back = v.spark.read.schema(trend.schema).option("header", True).csv(path)
    return back.withColumn("trend", F.round("trend", 6))


@query("s06_bulk_load", "SELECT * FROM items_15min")
def _(v):
    source, table = _path(v, "s06"), _path(v, "s06-table")
    rows = _like(v.items_15min, schemas.ITEMS_15MIN)
    rows.write.option("header", True).option("quoteAll", True).csv(source)
    return S.bulk_load(v.spark, source, schemas.ITEMS_15MIN, table)


@query(
    "s07_dual_staging",
    """SELECT 'csv' AS format, location_num, business_date, sales_sub_total FROM sales_daily
    UNION ALL SELECT 'parquet', location_num, business_date, sales_sub_total FROM sales_daily""",
)
def _(v):
    csv, parquet = _path(v, "s07-csv"), _path(v, "s07-parquet")
    rows = _like(v.sales_daily, schemas.SALES_DAILY)
    S.write_dual(rows, csv, parquet)
    columns = [LOC, DAY, "sales_sub_total"]
    from_csv = S.read_csv_dir(v.spark, csv, schemas.SALES_DAILY).select(
        F.lit("csv").alias("format"), *columns
    )
    from_parquet = v.spark.read.schema(schemas.SALES_DAILY).parquet(parquet)
    return from_csv.unionByName(
        from_parquet.select(F.lit("parquet").alias("format"), *columns)
    )


@query("s08_truncate_and_reload", "SELECT * FROM ycf WHERE generation_date = DATE '2001-06-30'")
def _(v):
    path = _path(v, "s08")
    S.reload(v.ycf, path)
    return S.reload(v.ycf.where(F.col(GEN) == F.lit(days(-1))), path)


@query("s09_document_sink", f"SELECT * REPLACE ({_DOC_TEXT}) FROM document_lines")
def _(v):
    back = D.scan_documents(v.spark, _written_documents(v)).withColumns(
        {
            LOC: F.col("Forecast.StoreNumber").cast("int"),
            DAY: F.to_date(F.substring("Forecast.BusinessDay", 1, 10)),
        }
    )
    return flat_document(back)


def _written_documents(v: Views) -> str:
    path = _path(v, "documents")
    D.write_documents(Documents(v, stored=True).build(), path)
    return path


@query(
    "s10_document_scan",
    """SELECT 'metric' detail, storenumber store_number, business_date, count(*) rows_count,
      CAST(sum(m.sales) AS DECIMAL(18,2)) total FROM all_doc_metrics m
    JOIN (SELECT location_num, business_date, storenumber FROM doc_header)
      USING (location_num, business_date) GROUP BY ALL
    UNION ALL SELECT 'item', lpad(CAST(location_num AS VARCHAR), 5, '0'), business_date,
      count(*), CAST(sum(transactioncount) AS DECIMAL(18,2)) FROM all_doc_items
    JOIN (SELECT location_num, business_date FROM doc_header) USING (location_num, business_date)
    GROUP BY ALL
    UNION ALL SELECT 'ingredient', lpad(CAST(location_num AS VARCHAR), 5, '0'), business_date,
      count(*), CAST(sum(transactioncount) AS DECIMAL(18,2)) FROM doc_ingredients
    JOIN (SELECT location_num, business_date FROM doc_header) USING (location_num, business_date)
    GROUP BY ALL""",
)
def _(v):
    tables = D.read_documents(v.spark, _written_documents(v))
    parts = [
        D.detail_totals(tables[table], [measure]).select(
            F.lit(name).alias("detail"),
            "store_number",
            DAY,
            "rows_count",
            F.col(f"total_{measure}").cast("decimal(18,2)").alias("total"),
        )
        for name, table, measure in (
            ("metric", "MetricDetail", "Sales"),
            ("item", "SalesItemDetail", "TransactionCount"),
            ("ingredient", "InventoryItemDetail", "TransactionCount"),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "s11_small_file_compaction",
    f"SELECT location_num, business_date, dollarsales_flat, status, 'short' forecast_type, "
    f"{TODAY} run_date FROM alerts",
)
def _(v):
    source, out = _path(v, "s11"), _path(v, "s11-table")
    rows = DocumentChecks(v).alerts.select(LOC, DAY, "dollarsales_flat", "status")
    S.write_by_store(rows, source)
    return S.compact(v.spark, source, out, rows.schema, "short", AS_OF)


@query(
    "s11_rejected_values",
    """SELECT regexp_replace(location_num, '^0+', '') store_num, 'location_num' column_name,
      concat('store ', location_num) AS value, 'not a int' reason, count(*) rows_count
    FROM (SELECT lpad(CAST(location_num AS VARCHAR), 5, '0') location_num FROM alerts
      WHERE status <> 'Success') GROUP BY ALL""",
)
def _(v):
    source, out, rejected = _path(v, "s11r"), _path(v, "s11r-table"), _path(v, "s11r-rejected")
    rows = DocumentChecks(v).alerts.select(LOC, DAY, "dollarsales_flat", "status")
    store = F.lpad(F.col(LOC).cast("string"), 5, "0")
    bad = F.when(F.col("status") != "Success", F.concat(F.lit("store "), store)).otherwise(store)
    written = rows.withColumn("store_num", F.col(LOC)).withColumn(LOC, bad)
    written.write.partitionBy("store_num").option("header", True).csv(source)
    S.compact(v.spark, source, out, rows.schema, "short", AS_OF, rejected=rejected)
    found = v.spark.read.schema(S.REJECTS).parquet(rejected)
    store = F.regexp_extract("path", r"store_num=(\d+)", 1).alias("store_num")
    return found.groupBy(store, "column_name", "value", "reason").agg(F.count("*").alias("rows_count"))


@query(
    "s12_latest_partition",
    "SELECT max(business_date) business_date FROM latest_sales_daily",
)
def _(v):
    path = _path(v, "s12")
    v.latest_sales_daily.repartition(DAY).write.partitionBy(DAY).parquet(path)
    return S.latest_partition(v.spark.read.parquet(path), DAY, AS_OF)


@query(
    "s13_recent_documents",
    "SELECT storenumber store_number, business_date FROM doc_header",
)
def _(v):
    return D.list_documents(v.spark, _written_documents(v), AS_OF)


@query(
    "s14_latest_export",
    "SELECT DISTINCT * FROM ycf WHERE generation_date = (SELECT max(generation_date) FROM ycf)",
)
def _(v):
    path = _path(v, "s14")
    S.export_latest(v.ycf, path)
    return S.read_csv_dir(v.spark, path, v.ycf.schema)


@query(
    "s15_restore_from_history",
    """SELECT 'emptied' AS live, * FROM recipe UNION ALL SELECT 'kept', * FROM recipe""",
)
def _(v):
    emptied = S.restore_if_needed(v.recipe.where("pin < 0"), v.recipe_history)
    kept = S.restore_if_needed(v.recipe, v.recipe_history)
    return emptied.select(F.lit("emptied").alias("live"), "*").unionByName(
        kept.select(F.lit("kept").alias("live"), "*")
    )


@query("s16_routed_sink", "SELECT location_num, business_date, status FROM alerts")
def _(v):
    rows = DocumentChecks(v).alerts.select(LOC, DAY, "status")
    passed, held = S.route(rows, _path(v, "s16"))
    passed = passed.withColumn("status", F.lit("Success"))
    return passed.unionByName(held.withColumn("status", F.lit("Failed")))


@query("o03_sorted_store_files", "SELECT *, location_num store_num FROM sales_daily")
def _(v):
    path = _path(v, "o03")
    S.sorted_write(_like(v.sales_daily, schemas.SALES_DAILY), path, [DAY, GEN])
    declared = T.StructType([*schemas.SALES_DAILY, T.StructField("store_num", T.IntegerType())])
    return v.spark.read.schema(declared).option("header", True).csv(path)


# -- streams ---------------------------------------------------------------------------


@query(
    "t01_document_arrivals",
    f"""SELECT storenumber location_num, business_date, 'short' forecast_type,
      {TODAY} generation_date, {TODAY} row_entry_date FROM doc_header""",
)
def _(v):
    return arrivals.stream_arrivals(
        v.spark,
        _written_documents(v),
        _path(v, "t01"),
        _path(v, "t01-checkpoint"),
        "short",
        AS_OF,
    )


_STAMP = "yyyy-MM-dd HH:mm:ss"


@query(
    "t02_arrival_registry",
    """SELECT concat(storenumber, '/demand-', strftime(business_date, '%m-%d-%Y'), '.json') file_name,
      CASE WHEN business_date = newest THEN '2001-07-02' ELSE '2001-07-01' END generation_date,
      concat(CAST(CAST(business_date AS DATE) AS VARCHAR), ' 06:00:00') arrived_at,
      strftime(business_date + INTERVAL 66 HOURS, '%Y-%m-%d %H:%M:%S') expires_at
    FROM (SELECT *, max(business_date) OVER () newest FROM doc_header)
    WHERE business_date + INTERVAL 60 HOURS > newest""",
)
def _(v):
    """Documents arrive at six on their business date; the newest date's come once more."""
    documents = Documents(v, stored=True).build()
    dates = [r[0] for r in documents.select(DAY).distinct().orderBy(DAY).collect()]
    source, out, mark = _path(v, "t02-docs"), _path(v, "t02"), _path(v, "t02-checkpoint")
    arrived = document_date(F.col("_path")).cast("timestamp") + F.expr("INTERVAL 6 HOURS")
    again = documents.withColumn("GenerationDate", F.lit("2001-07-02T00:00:00.000Z"))
    batches = [documents.where(F.col(DAY) == d) for d in dates] + [
        again.where(F.col(DAY) == d) for d in dates[-1:]
    ]
    registry = None
    for batch in batches:  # one run of the stream for each delivery, from the same checkpoint
        D.write_documents(batch, source, "append")
        registry = arrivals.stream_registry(v.spark, source, out, mark, arrived_at=arrived)
    return registry.select(
        "file_name",
        "generation_date",
        F.date_format("arrived_at", _STAMP).alias("arrived_at"),
        F.date_format("expires_at", _STAMP).alias("expires_at"),
    )


@query(
    "t02_first_arrivals",
    """SELECT user_id, event_type, strftime(max(ts) FILTER (starts), '%Y-%m-%d %H:%M:%S') first_at,
      strftime(max(ts), '%Y-%m-%d %H:%M:%S') last_at
    FROM (SELECT user_id, event_type, ts, max(ts) OVER () clock, coalesce(ts >= lag(ts)
        OVER (PARTITION BY user_id, event_type ORDER BY ts) + INTERVAL 60 HOURS, true) starts
      FROM events)
    GROUP BY 1, 2 HAVING max(ts) + INTERVAL 60 HOURS > any_value(clock)""",
)
def _(v):
    """Events as arrivals: per user and type, since when the live entry has not expired.

    Four deliveries by time, the third of them twice.
    """
    source, out, mark = _path(v, "t02-events"), _path(v, "t02-first"), _path(v, "t02-first-mark")
    events = v.table("events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    bounds = events.agg(F.min("ts"), F.max("ts")).first()
    quarter = F.floor(
        4 * (F.col("ts").cast("double") - F.lit(bounds[0]).cast("double"))
        / (F.lit(bounds[1]).cast("double") - F.lit(bounds[0]).cast("double") + 1)
    )
    registry = None
    for part in (0, 1, 2, 2, 3):
        events.where(quarter == part).write.mode("append").parquet(source)
        entries = v.spark.readStream.schema(events.schema).parquet(source).select(
            F.concat_ws("/", "user_id", "event_type").alias("file_name"),
            F.lit("").alias("generation_date"),
            F.col("ts").alias("arrived_at"),
        )
        registry = arrivals.stream_entries(entries, out, mark)
    key = F.split("file_name", "/")
    return registry.select(
        key[0].cast("long").alias("user_id"),
        key[1].alias("event_type"),
        F.date_format("first_at", _STAMP).alias("first_at"),
        F.date_format("arrived_at", _STAMP).alias("last_at"),
    )


@query(
    "t03_yield_factor_arrival",
    f"SELECT location_num, ingredient_id, ycf, {TODAY} generation_date FROM ycf",
)
def _(v):
    source = _path(v, "t03")
    record = F.struct(
        F.format_string("%05d", F.col(LOC)).alias("StoreNumber"),
        F.col("ingredient_id").cast("string").alias("ItemCode"),
        F.col("ycf").alias("YieldCorrectionFactor"),
    )
    (
        v.ycf.groupBy(LOC)
        .agg(F.to_json(F.collect_list(record)).alias("value"))
        .withColumnRenamed(LOC, "store_folder")
        .write.partitionBy("store_folder")
        .text(source)
    )
    return arrivals.stream_ycf(
        v.spark, source, _path(v, "t03-table"), _path(v, "t03-checkpoint"), AS_OF
    )


# -- row predicates and grouped maps -----------------------------------------------------


@query(
    "x01_row_predicates",
    """SELECT location_num, prediction_date, isodow(prediction_date) = 7 OR
      (isodow(prediction_date) = 6 AND location_num IN (SELECT location_num FROM saturday_off))
      closed, (month(prediction_date) = 12 AND day(prediction_date) = 25) OR
      (month(prediction_date) = 11 AND day(prediction_date) BETWEEN 22 AND 28
        AND isodow(prediction_date) = 4) holiday
    FROM (SELECT location_num, business_date prediction_date FROM latest_sales_daily)""",
)
def _(v):
    rows = with_saturday_off(
        v.latest_sales_daily.select(LOC, F.col(DAY).alias("prediction_date")), v.saturday_off
    )
    day = F.col("prediction_date")
    return rows.select(
        LOC,
        "prediction_date",
        closed_day(day, F.col("_sat_off")).alias("closed"),
        is_closed_holiday(day).alias("holiday"),
    )


def _running(segment: pd.DataFrame) -> pd.DataFrame:
    before = segment["before"].fillna(0.0)
    return segment.assign(running=before + segment["quantity"].cumsum()).drop(columns=["quantity", "before"])


@query(
    "x02_grouped_map",
    """SELECT location_num, product, business_date, round(sum(CAST(sum_daily_quantity AS DOUBLE))
      OVER (PARTITION BY location_num, product ORDER BY business_date), 2) running
    FROM latest_items_daily""",
)
def _(v):
    rows = v.latest_items_daily.select(
        LOC, "product", DAY, F.col("sum_daily_quantity").cast("double").alias("quantity")
    )
    schema = f"{LOC} int, product int, {DAY} date, running double"
    sums = {"before": (F.sum("quantity"), F.sum)}
    out = scan_by_key(rows, [LOC, "product"], [DAY], sums, _running, schema)
    return out.withColumn("running", F.round("running", 2))


@query(
    "p15_horizon_dates",
    f"""SELECT location_num, unnest([{", ".join(
        f"DATE '{d}'" for h in HORIZONS for d in horizon_dates(AS_OF, h)
    )}]) business_date FROM stores""",
)
def _(v):
    from tillcast.operators.joins import scaffold

    return scaffold(v.stores, [d for h in HORIZONS for d in horizon_dates(AS_OF, h)])

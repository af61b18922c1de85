"""Nested JSON documents: one per store and business date."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast import schemas
from tillcast.functions.calendar import us_date
from tillcast.functions.text import document_date, document_store

# Folder layout of delivered documents: <store>/demand=<MM-dd-yyyy>/.
_FOLDERS = ["store_folder", "demand"]


def write_documents(documents: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Writes ``Forecast`` and ``GenerationDate`` below store and date folders.

    A document is one JSON line.  Rows are spread by store and date, so no
    store's year of documents has to pass through one task.
    """
    day = F.to_date(F.substring("Forecast.BusinessDay", 1, 10))
    out = documents.select(
        "Forecast",
        "GenerationDate",
        F.col("Forecast.StoreNumber").alias("store_folder"),
        us_date(day).alias("demand"),
    )
    out.repartition(*_FOLDERS).write.partitionBy(*_FOLDERS).mode(mode).json(path)


def scan_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents below a folder, with their path."""
    return (
        spark.read.schema(schemas.DOCUMENT)
        .option("recursiveFileLookup", True)
        .json(path)
        .withColumn("path", F.col("_metadata.file_path"))
    )


def detail_tables(documents: DataFrame) -> dict[str, DataFrame]:
    """The three detail arrays as flat tables."""
    head = [
        F.col("Forecast.StoreNumber").alias("store_number"),
        F.to_date(F.substring("Forecast.BusinessDay", 1, 10)).alias("business_date"),
        F.substring("GenerationDate", 1, 10).alias("generation_date"),
    ]
    flat = {}
    for name in ("MetricDetail", "SalesItemDetail", "InventoryItemDetail"):
        rows = documents.select(*head, F.explode(f"Forecast.{name}").alias("_d"))
        flat[name] = rows.select("store_number", "business_date", "generation_date", "_d.*")
    return flat


def read_documents(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return detail_tables(scan_documents(spark, path))


def detail_totals(details: DataFrame, measures: list[str], code: str | None = None) -> DataFrame:
    """Rows, distinct codes and summed measures per document."""
    aggs = [F.count(F.lit(1)).alias("rows_count")]
    if code:
        aggs.append(F.countDistinct(code).alias("code_count"))
    aggs += [F.sum(F.col(m).cast("decimal(18,2)")).alias(f"total_{m}") for m in measures]
    return details.groupBy("store_number", "business_date", "generation_date").agg(*aggs)


def list_documents(
    spark: SparkSession, path: str, as_of: date, days: int = 12
) -> DataFrame:
    """Store and date of every document file changed in the last ``days`` days.

    Only file metadata is read; ``as_of`` stands for today.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("modifiedAfter", f"{as_of - timedelta(days=days)}T00:00:00")
        .option("pathGlobFilter", "*.json")
        .load(path)
        .select("path")
    )
    return files.select(
        document_store(F.col("path")).alias("store_number"),
        document_date(F.col("path")).alias("business_date"),
    ).distinct()

"""Arriving files as streams.  Each run takes what is new and stops.

Progress lives in the checkpoint folder, which must be shared storage: a run
that lost its executors or its driver continues where the last batch ended.
Batches are written to a folder named after the batch id with overwrite, so a
batch that is repeated after a failure replaces itself.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillcast import schemas
from tillcast.functions.text import document_date, document_store, strip_zeros


def _run(stream: DataFrame, checkpoint: str, write_batch) -> StreamingQuery:
    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _append_batch(out: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return write


def run_append(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Runs the stream over what is there and writes every batch to its own folder."""
    return _run(stream, checkpoint, _append_batch(out))


def _documents(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    return (
        spark.readStream.schema(schemas.DOCUMENT)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
        .withColumns(
            {
                "_path": F.col("_metadata.file_path"),
                "arrived_at": F.col("_metadata.file_modification_time"),
            }
        )
    )


def stream_arrivals(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    forecast_type: str,
    as_of: date,
    files_per_batch: int = 10_000,
) -> DataFrame:
    """Log of delivered documents: one row per document."""
    log = _documents(spark, path, files_per_batch).select(
        document_store(F.col("_path")).alias("location_num"),
        document_date(F.col("_path")).alias("business_date"),
        F.lit(forecast_type).alias("forecast_type"),
        F.to_date(F.substring("GenerationDate", 1, 10)).alias("generation_date"),
        F.lit(as_of).alias("row_entry_date"),
    )
    run_append(log, out, checkpoint)
    return spark.read.parquet(out).drop("batch")


REGISTRY_HOURS = 60  # fixed value: how long an entry is kept
REGISTRY = "file_name string, generation_date string, first_at timestamp, arrived_at timestamp, batch long"


def _life() -> Column:
    return F.make_dt_interval(hours=F.lit(REGISTRY_HOURS))


def stream_registry(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    files_per_batch: int = 10_000,
    arrived_at: Column | None = None,
) -> DataFrame:
    """Registry of delivered documents by file name; see :func:`stream_entries`.

    A document arrives when its file was last changed, unless ``arrived_at`` says otherwise.
    """
    rows = _documents(spark, path, files_per_batch)
    if arrived_at is not None:
        rows = rows.withColumn("arrived_at", arrived_at)
    entries = rows.select(
        F.concat(
            document_store(F.col("_path")),
            F.lit("/demand-"),
            F.date_format(document_date(F.col("_path")), "MM-dd-yyyy"),
            F.lit(".json"),
        ).alias("file_name"),
        F.substring("GenerationDate", 1, 10).alias("generation_date"),
        "arrived_at",
    )
    return stream_entries(entries, out, checkpoint)


def stream_entries(entries: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Live entries after all that arrived: file_name, generation_date, first_at, arrived_at, expires_at.

    ``entries`` is a stream of (file_name, generation_date, arrived_at).  A later arrival
    replaces an earlier one and renews its expiry; one that comes after the expiry starts a
    new entry with its own ``first_at``.  The clock is the newest arrival so far.

    Every batch merges with what the batch before it left and drops what expired by then.
    Batches write to two folders by turns, so a batch that is repeated after a failure reads
    the same state again, and the disk holds two states of at most the live entries and one
    batch each.  ``out`` belongs to ``checkpoint``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        known = _state(batch.sparkSession, out).where(F.col("batch") == batch_id - 1)
        known = live_entries(known, _clock(known)).select("file_name", "generation_date", "first_at", "arrived_at")
        new = batch.select(
            "file_name", "generation_date", F.lit(None).cast("timestamp").alias("first_at"), "arrived_at"
        )
        merged = _newest_arrival(known.unionByName(new)).withColumn("batch", F.lit(batch_id).cast("long"))
        merged.write.mode("overwrite").parquet(f"{out}/slot={batch_id % 2}")

    _run(entries, checkpoint, write)
    return registry(entries.sparkSession, out)


def registry(spark: SparkSession, out: str) -> DataFrame:
    """The live entries of the newest state."""
    state = _state(spark, out)
    newest = state.where(F.col("batch") == state.agg(F.max("batch")).first()[0])
    return live_entries(newest, _clock(newest)).drop("batch")


def _state(spark: SparkSession, out: str) -> DataFrame:
    """Both states with their expiry; none before the first batch."""
    try:
        rows = spark.read.schema(REGISTRY).parquet(out)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], REGISTRY)
    columns = [f.split()[0] for f in REGISTRY.split(", ")]
    return rows.select(*columns, (F.col("arrived_at") + _life()).alias("expires_at"))


def _clock(entries: DataFrame) -> Column:
    return F.lit(entries.agg(F.max("arrived_at")).first()[0]).cast("timestamp")


def _newest_arrival(rows: DataFrame) -> DataFrame:
    """Per file name the newest arrival and where its unbroken run of lives starts.

    A row is a life from its first to its newest arrival; lives that overlap or follow
    each other within the hours are one.
    """
    begins = F.coalesce("first_at", "arrived_at")
    earlier = Window.partitionBy("file_name").orderBy(begins, "arrived_at")
    reached = F.max("arrived_at").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(reached.isNull() | (begins >= reached + _life()), begins)
    return (
        rows.withColumn("_start", starts)
        .groupBy("file_name")
        .agg(
            F.max_by("generation_date", F.struct("arrived_at", "generation_date")).alias("generation_date"),
            F.max("_start").alias("first_at"),
            F.max("arrived_at").alias("arrived_at"),
        )
    )


def live_entries(entries: DataFrame, now) -> DataFrame:
    """Registry entries that have not expired."""
    return entries.where(F.col("expires_at") > now)


def stream_ycf(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    as_of: date,
    files_per_batch: int = 10_000,
) -> DataFrame:
    """Yield factors out of arriving record arrays, stamped with the run date."""
    rows = (
        spark.readStream.schema(schemas.YCF_ARRIVAL)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
        .select(
            strip_zeros(F.col("StoreNumber")).try_cast("int").alias("location_num"),
            F.col("ItemCode").try_cast("int").alias("ingredient_id"),
            F.col("YieldCorrectionFactor").alias("ycf"),
            F.lit(as_of).alias("generation_date"),
        )
    )
    run_append(rows, out, checkpoint)
    return spark.read.parquet(out).drop("batch")


"""Delimited, Parquet and table files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.operators.snapshot import GENERATION, latest_snapshot


def read_csv_dir(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> DataFrame:
    """Every CSV file below a folder, with a declared schema (one scan, no inference)."""
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("recursiveFileLookup", True)
        .option("enforceSchema", True)
        .csv(path)
    )


def _by_store(df: DataFrame) -> DataFrame:
    """Rows gathered by store; adaptive execution splits a store that is too large."""
    return df.hint("rebalance", "location_num")


def write_by_store(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV folders ``store_num=<n>``, copied from ``location_num``."""
    stamped = _by_store(df.withColumn("store_num", F.col("location_num")))
    stamped.write.partitionBy("store_num").mode(mode).option("header", True).csv(path)


def sorted_write(df: DataFrame, path: str, order: list[str], mode: str = "overwrite") -> None:
    """Store-partitioned CSV whose rows are sorted inside every file."""
    (
        _by_store(df.withColumn("store_num", F.col("location_num")))
        .sortWithinPartitions("store_num", *order)
        .write.partitionBy("store_num")
        .mode(mode)
        .option("header", True)
        .csv(path)
    )


def write_single(df: DataFrame, path: str, order: list[str]) -> None:
    """One sorted CSV file, for control tables of a few rows per store and date.

    Only the sort and the write share one task, by contract; the rows are
    computed in parallel before.  Do not use it for facts.
    """
    df.repartition(1).sortWithinPartitions(*order).write.mode("overwrite").option(
        "header", True
    ).csv(path)


def bulk_load(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    target: str,
    skip_header: bool = True,
) -> DataFrame:
    """Appends quoted CSV, matched to the schema by position, to a Parquet table."""
    rows = (
        spark.read.schema(schema)
        .option("header", skip_header)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("recursiveFileLookup", True)
        .csv(path)
    )
    rows.write.mode("append").parquet(target)
    return spark.read.schema(schema).parquet(target)


def write_dual(df: DataFrame, csv_path: str, parquet_path: str) -> None:
    """The same rows as CSV and as Parquet partitioned by store.

    In the Parquet copy the store lives in the path only.
    """
    df.write.mode("overwrite").option("header", True).csv(csv_path)
    _by_store(df).write.partitionBy("location_num").mode("overwrite").parquet(parquet_path)


def reload(df: DataFrame, table_path: str) -> DataFrame:
    """Replaces the whole table with new rows."""
    df.write.mode("overwrite").parquet(table_path)
    return df.sparkSession.read.schema(df.schema).parquet(table_path)


# One CSV field: quoted with doubled quotes inside, or plain; it follows a comma or the start.
_FIELD = r'(?<=^|,)("(?:[^"]|"")*"|[^,]*)'
REJECTS = "path string, column_name string, value string, reason string"


def _fields(line: Column) -> Column:
    """Fields of a header line, unquoted."""
    raw = F.regexp_extract_all(line, F.lit(_FIELD), 1)

    def unquote(x: Column) -> Column:
        inner = F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
        return F.when(x.startswith('"'), inner).otherwise(x)

    return F.transform(raw, unquote)


def _small_files(spark: SparkSession, source: str):
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    return found.option("ignoreMissingFiles", True).option("ignoreCorruptFiles", True)


def _headers(spark: SparkSession, source: str, names: list[str]) -> DataFrame:
    """(path, names, known): the header of every file; ``known`` if it has a wanted column.

    A file's first line is told by its place in the scan; files are small and not split.
    """
    lines = _small_files(spark, source).text(source).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        F.regexp_replace("value", "[\r\ufeff]", "").alias("_line"),
    )
    first = lines.where("_block = 0").groupBy("path").agg(F.min_by("_line", "_at").alias("_line"))
    fields = first.select("path", _fields(F.col("_line")).alias("names"))
    return fields.withColumn("known", F.arrays_overlap("names", F.array(*map(F.lit, names))))


def read_small_files(
    spark: SparkSession, source: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """CSV files of a few rows each, whose headers may differ: their rows, and what was rejected.

    The CSV reader parses quotes and line breaks inside them, all files in one scan; a
    file's own header, joined by its path, then says which column a field belongs to.  Of a
    name that a header repeats the first column counts; columns a file lacks are NULL.

    The second frame is :data:`REJECTS`: files that cannot be read or have no wanted
    column; repeated columns; values that are not of their column's type; fields beyond
    the header.  Files of no bytes hold nothing and are in neither.
    """
    headers = _headers(spark, source, schema.names)
    width = headers.where("known").agg(F.max(F.size("names"))).first()[0] or 1
    cells = [f"_c{k}" for k in range(width + 1)]  # one more than the widest header
    raw = (
        _small_files(spark, source)
        .schema(", ".join(f"{c} string" for c in cells))
        .option("header", True)
        .option("enforceSchema", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(source)
        .select(F.col("_metadata.file_path").alias("path"), F.array(*cells).alias("_cells"))
        .where(F.exists("_cells", lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""))
    )
    rows = raw.join(headers.where("known").drop("known"), "path")

    def text(field: T.StructField) -> Column:
        value = F.get("_cells", F.array_position("names", F.lit(field.name)).cast("int") - 1)
        return F.when(F.array_contains("names", field.name) & (value != ""), value)

    good = rows.select(*[text(f).try_cast(f.dataType).alias(f.name) for f in schema])

    def reject(name: Column, value: Column, reason: str) -> Column:
        return F.struct(
            name.alias("column_name"), value.alias("value"), F.lit(reason).alias("reason")
        )

    bad = [
        F.when(
            text(f).isNotNull() & text(f).try_cast(f.dataType).isNull(),
            reject(F.lit(f.name), text(f), f"not a {f.dataType.simpleString()}"),
        )
        for f in schema
    ]
    beyond = F.slice("_cells", F.size("names") + 1, len(cells))
    beyond = F.transform(
        F.filter(beyond, lambda c: c.isNotNull()),
        lambda c: reject(F.lit(None).cast("string"), c, "beyond the header"),
    )
    values = rows.select("path", F.explode(F.concat(F.array_compact(F.array(*bad)), beyond)).alias("_r"))
    repeated = F.filter(
        F.array_distinct("names"), lambda n: F.size(F.filter("names", lambda m: m == n)) > 1
    )
    columns = headers.where("known").select(
        "path",
        F.explode(
            F.transform(repeated, lambda n: reject(n, F.lit(None).cast("string"), "repeated column"))
        ).alias("_r"),
    )
    listed = _small_files(spark, source).format("binaryFile").load(source)
    listed = listed.select(F.col("_metadata.file_path").alias("path"))  # no content is read
    why = F.when(F.col("known").isNull(), "unreadable")
    files = listed.join(headers, "path", "left").where("not coalesce(known, false)")
    nothing = F.lit(None).cast("string")
    files = files.select(
        "path",
        nothing.alias("column_name"),
        nothing.alias("value"),
        why.otherwise("no wanted column").alias("reason"),
    )
    rejects = values.unionByName(columns).select("path", "_r.*").unionByName(files)
    return good, rejects


def compact(
    spark: SparkSession,
    source: str,
    out: str,
    schema: T.StructType,
    forecast_type: str,
    generation_date,
    rows_per_file: int = 5_000_000,
    rejected: str | None = None,
) -> DataFrame:
    """Many small alert CSVs to Parquet under forecast type and generation date.

    Columns a file lacks are NULL.  Files and values that cannot be used are written to
    the ``rejected`` folder, if one is given.  The number of files follows the number of
    rows, not the number of inputs.
    """
    rows, rejects = read_small_files(spark, source, schema)
    stamped = rows.withColumns(
        {"forecast_type": F.lit(forecast_type), "run_date": F.lit(generation_date)}
    )
    # A rebalance hint lets adaptive execution size the output files.
    (
        stamped.hint("rebalance")
        .write.partitionBy("forecast_type", "run_date")
        .option("maxRecordsPerFile", rows_per_file)
        .mode("append")
        .parquet(out)
    )
    if rejected is not None:
        rejects.write.mode("append").parquet(rejected)
    return spark.read.schema(stamped.schema).parquet(out)


def latest_partition(df: DataFrame, col: str, fallback) -> DataFrame:
    """Newest value of a partition column, or the fallback for an empty table."""
    return df.agg(F.coalesce(F.max(col), F.lit(fallback)).alias(col))


def export_latest(df: DataFrame, path: str, col: str = GENERATION) -> None:
    """Distinct rows of the newest snapshot as CSV."""
    latest_snapshot(df, col).distinct().write.mode("overwrite").option("header", True).csv(path)


def restore_if_needed(live: DataFrame, history: DataFrame, col: str = GENERATION) -> DataFrame:
    """Live rows, plus the newest history snapshot unless live holds exactly one."""
    snapshots = live.agg(F.countDistinct(col)).scalar()
    backup = latest_snapshot(history, col).distinct().where(snapshots != 1)
    return live.unionByName(backup.select(*live.columns))


def route(df: DataFrame, path: str, verdict: str = "status") -> tuple[DataFrame, DataFrame]:
    """Passing rows to ``path/delivered=true``, all others to ``path/delivered=false``.

    Returns both as read back.  The rows are computed once and written by one job, which
    publishes both folders together when it commits, so a row is in exactly one of them
    even if its verdict would come out differently a second time.
    """
    passed = F.coalesce(F.col(verdict) == "Success", F.lit(False))
    routed = df.withColumn("delivered", passed)
    routed.write.partitionBy("delivered").mode("overwrite").parquet(path)
    back = df.sparkSession.read.schema(routed.schema).parquet(path)
    return back.where("delivered").drop("delivered"), back.where("not delivered").drop("delivered")

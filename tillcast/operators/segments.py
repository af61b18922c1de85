"""Groups cut into bounded, ordered segments.

A group that may hold a third of all rows cannot be a window, a percentile buffer or a
Python call of its own.  Its rows are range-sorted, so that they lie in several tasks, and
cut into segments of a bounded number of rows; each segment gives a small summary, and a
window over the summaries says what lies before it.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import new_path

ROWS = 100_000  # of a segment, at most


def segmented(df: DataFrame, keys: list[str], order: list[str], rows: int = ROWS) -> DataFrame:
    """The rows with ``_segment``: ascending in ``order`` within a group, at most ``rows`` each.

    Written once, so that all readers see the same segments.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    # the place of a row in its partition, and partitions far apart
    placed = ranged.withColumn("_segment", F.floor(F.monotonically_increasing_id() / rows))
    path = new_path(spark, "segments")
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def _before(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)


def matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Both frames' columns on equal keys; a key that is null is a group like others."""
    right = right.withColumnsRenamed({k: f"_r{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in keys]
    return left.join(right, same, how).drop(*(f"_r{k}" for k in keys))


def scan_by_key(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    summary: dict[str, tuple[Column, Callable[[str], Column]]],
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema,
    rows: int = ROWS,
) -> DataFrame:
    """A grouped map for groups of any size, one call for each segment.

    ``summary`` names what a segment needs to know of the rows before it: an aggregate
    over a segment, and the aggregate that combines those of several.  ``fn`` takes a
    segment's rows in order, with these as further columns, null in a group's first segment.
    """
    cut = segmented(df, keys, order, rows)
    parts = cut.groupBy(*keys, "_segment").agg(*[of.alias(n) for n, (of, _) in summary.items()])
    carried = parts.select(
        *keys, "_segment", *[combine(n).over(_before(keys)).alias(n) for n, (_, combine) in summary.items()]
    )
    joined = matched(cut, carried, [*keys, "_segment"])

    def run(segment: pd.DataFrame) -> pd.DataFrame:
        return fn(segment.sort_values(order, ignore_index=True).drop(columns="_segment"))

    return joined.groupBy(*keys, "_segment").applyInPandas(run, schema)


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, shares: dict[str, float], rows: int = ROWS
) -> DataFrame:
    """Interpolated quantiles per key, one column for each named share, exact.

    Equal values are counted first; running totals over the segments of the counts say
    which segment holds a rank, and only those segments are read for it.  Null values do
    not count; a key without others has null quantiles.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    cut = segmented(counts, keys, [value], rows)
    parts = cut.groupBy(*keys, "_segment").agg(F.sum("_n").alias("_held"))
    whole = Window.partitionBy(*keys)
    parts = parts.withColumn("_past", F.coalesce(F.sum("_held").over(_before(keys)), F.lit(0)))
    parts = parts.withColumn("_all", F.sum("_held").over(whole))
    ranks = []
    for name, share in shares.items():
        at = (F.col("_all") - 1) * F.lit(float(share))
        for side, rank in (("low", F.floor(at)), ("high", F.ceil(at))):
            ranks.append(
                F.struct(
                    F.lit(f"{name}/{side}").alias("what"),
                    rank.alias("rank"),
                    (at - F.floor(at)).alias("part"),
                )
            )
    wanted = parts.select(*keys, "_segment", "_past", "_held", F.explode(F.array(*ranks)).alias("_w"))
    wanted = wanted.where((F.col("_w.rank") >= F.col("_past")) & (F.col("_w.rank") < F.col("_past") + F.col("_held")))
    asked = wanted.groupBy(*keys, "_segment", "_past").agg(F.collect_list("_w").alias("_ws"))
    read = matched(cut, asked, [*keys, "_segment"])
    running = Window.partitionBy(*keys, "_segment").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    read = read.withColumn("_upto", F.col("_past") + F.sum("_n").over(running))
    hits = read.withColumn(
        "_w",
        F.explode(
            F.filter("_ws", lambda w: (w["rank"] < F.col("_upto")) & (w["rank"] >= F.col("_upto") - F.col("_n")))
        ),
    )

    def of(what: str, column: str) -> Column:
        return F.max(F.when(F.col("_w.what") == what, F.col(column)))

    out = []
    for name in shares:
        low, high = of(f"{name}/low", value).cast("double"), of(f"{name}/high", value).cast("double")
        out.append((low + (high - low) * of(f"{name}/low", "_w.part")).alias(name))
    found = hits.groupBy(*keys).agg(*out)
    return matched(df.select(*keys).distinct(), found, keys, "left")

"""Versioned reads.  ``generation_date`` is the version of every fact table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GENERATION = "generation_date"
LAGGING = 100  # keys that a scan may name


def not_before(df: DataFrame, col: str, bounds: DataFrame, bound: str) -> DataFrame:
    """Rows at or after the smallest bound of a small frame.

    For use before joining a fact table with a frame aggregated from it.  The
    planner cannot know that frame is small and shuffles the facts; the scalar
    sub-query reaches the scan, skips row groups and leaves little to shuffle.
    """
    return df.where(F.col(col) >= bounds.agg(F.min(bound)).scalar())


def latest_snapshot(
    df: DataFrame,
    col: str = GENERATION,
    keys: list[str] | None = None,
    control: DataFrame | None = None,
) -> DataFrame:
    """Rows of the newest version, over the table or per key.

    The maximum is a partially aggregated group-by of two or three columns,
    and the table is filtered with it by a scalar sub-query or a semi join.
    No row of the table enters a window, so one store with a third of the rows
    does not end up in one task.  With a ``control`` table (:func:`newest_versions`)
    the table is read once, and only where its keys say.
    """
    if not keys:
        return df.where(F.col(col) == df.agg(F.max(col)).scalar())
    if control is not None:
        return current(df, control, col, keys)
    newest = df.groupBy(*keys).agg(F.max(col).alias(col))
    return not_before(df, col, newest, col).join(newest, [*keys, col], "left_semi")


def newest_versions(
    loads: DataFrame, keys: list[str], col: str = GENERATION, control: DataFrame | None = None
) -> DataFrame:
    """Control table: each key's newest version, from new ``loads`` and the one before.

    Only the loads are read, so keeping it up to date costs as much as a load, however
    long the history is.  A load that arrives late or twice changes nothing.
    """
    newest = loads.groupBy(*keys).agg(F.max(col).alias(col))
    if control is None:
        return newest
    both = control.select(*keys, col).unionByName(newest)
    return both.groupBy(*keys).agg(F.max(col).alias(col))


def current(
    df: DataFrame, control: DataFrame, col: str = GENERATION, keys: list[str] | None = None
) -> DataFrame:
    """Rows of the versions that a control table lists, in one scan of the table.

    The scan is bounded by the oldest of the newest versions.  The first ``LAGGING`` keys
    of the first column, by their newest version, are left out of that bound and named in
    the filter instead: a store closed for years reads its own row groups only, and all others
    from where they are.
    """
    keys = keys or [c for c in control.columns if c != col]
    first = keys[0]
    stores = control.groupBy(first).agg(F.min(col).alias(col)).where(F.col(first).isNotNull())
    oldest = stores.orderBy(col, first).limit(LAGGING + 1).collect()
    if oldest:
        bound = F.col(col) >= F.lit(oldest[-1][col])
        named = [r[first] for r in oldest if r[col] is not None and r[col] < oldest[-1][col]]
        df = df.where((bound | F.col(first).isin(named)) if named else bound)
    return df.join(control.select(*keys, col), [*keys, col], "left_semi")


def dedupe_latest(
    df: DataFrame, keys: list[str], values: list[str], col: str = GENERATION
) -> DataFrame:
    """Per natural key the values of its newest version, distinct; ties survive.

    Copies are folded map-side first; what the window then sees of one key is
    its distinct versions, one per load of that date.
    """
    versions = df.groupBy(*keys, *values).agg(F.max(col).alias(col))
    newest = F.max(col).over(Window.partitionBy(*keys))
    return (
        versions.withColumn("_newest", newest).where(F.col(col) == F.col("_newest")).drop("_newest")
    )


def _newest_day() -> Column:
    """Newest version and, within it, the newest business date, in one aggregate."""
    return F.max(
        F.when(F.col(GENERATION).isNotNull(), F.struct(GENERATION, "business_date"))
    )


def newest_load(df: DataFrame) -> DataFrame:
    """Newest business date of the newest load, and its version."""
    return df.agg(_newest_day().alias("_n")).select("_n.business_date", f"_n.{GENERATION}")


def gap_stores(df: DataFrame, days: int = 15, key: str = "location_num") -> DataFrame:
    """Stores whose newest load follows their previous one by more than ``days``.

    One pass: per store and version first, then the newest version of the
    table is told from the ones before it.
    """
    loads = df.groupBy(key, GENERATION).agg(F.count(F.lit(1)).alias("_rows"))
    newest = df.agg(F.max(GENERATION)).scalar()
    split = loads.withColumn("_current", F.col(GENERATION) == newest)
    return (
        split.groupBy(key)
        .agg(
            F.max(F.when(F.col("_current"), F.col(GENERATION))).alias("current_date_loaded"),
            F.max(F.when(~F.col("_current"), F.col(GENERATION))).alias("previous_date_loaded"),
        )
        .where(F.datediff("current_date_loaded", "previous_date_loaded") > days)
    )


def incremental_bounds(
    final: DataFrame,
    initial: DataFrame,
    key: str = "location_num",
    default: date | None = None,
    newest_load_only: bool = False,
) -> DataFrame:
    """Per store the open-closed range of dates still to prepare.

    Without a default a store missing from the target has no range; with one
    its range starts there.
    """
    newest = _newest_day()["business_date"] if newest_load_only else F.max("business_date")
    upper = initial.groupBy(key).agg(newest.alias("_through"))
    lower = final.groupBy(key).agg(F.max("business_date").alias("_after"))
    if default is None:
        return upper.join(lower, key, "inner")
    filled = F.coalesce("_after", F.lit(default))
    return upper.join(lower, key, "left").withColumn("_after", filled)


def incremental_slice(calendar: DataFrame, bounds: DataFrame) -> DataFrame:
    """Calendar rows of every store's range.

    Each store's range is expanded to its dates inside the row and joined to
    the calendar on the date; there is no range join and no cross join.  Whether
    the calendar is broadcast is decided by its size.
    """
    days = bounds.where(F.col("_after") < F.col("_through")).withColumn(
        "business_date", F.explode(F.sequence(F.date_add("_after", 1), F.col("_through")))
    )
    return days.drop("_after", "_through").join(calendar, "business_date")


def latest_dates(df: DataFrame, n: int, key: str = "location_num") -> DataFrame:
    """Newest ``n`` distinct business dates of every store."""
    dates = df.select(key, "business_date").distinct()
    return top_n_by(dates, [key], [F.desc("business_date")], n)


def top_n_by(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of every key.  Spark limits each key before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")

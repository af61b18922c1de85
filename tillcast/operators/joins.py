"""Join shapes.  Size decides broadcast at run time; nothing is hinted here."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.calendar import date_array, quarter_hours
from tillcast.functions.text import pad_store
from tillcast.operators.predicates import zero_fill

LOC = "location_num"


def pad(
    scaffold: DataFrame, facts: DataFrame, keys: list[str], measures: list[str]
) -> DataFrame:
    """Complete scaffold with facts where present and 0 elsewhere."""
    return zero_fill(scaffold.join(facts.select(*keys, *measures), keys, "left"), measures)


def full_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct full outer join, one job instead of LEFT union RIGHT."""
    return left.join(right, keys, "full_outer").distinct()


def scaffold(
    base: DataFrame, dates: list[date] | None = None, intervals: bool = False
) -> DataFrame:
    """Every base row on every date and quarter-hour.

    The fixed dimensions are literal arrays exploded inside the row: the base
    keeps its partitioning and no cross join or shuffle is needed.
    """
    out = base
    if dates is not None:
        out = out.withColumn("business_date", F.explode(date_array(dates)))
    if intervals:
        out = out.withColumn("interval", F.explode(quarter_hours()))
    return out


def range_lookback_join(facts: DataFrame, windows: DataFrame) -> DataFrame:
    """Facts of the same weekday with ``ly_min_date <= date < ly_fiscal_date``.

    Right outer: a window without facts keeps one row.  A window's days are listed inside
    the row, one a week, and met by equality of store and date, so the facts of a large
    store are spread over its dates and no pair outside a range is compared.
    """
    first = F.date_add(
        "ly_min_date", F.pmod(F.dayofweek("prediction_date") - F.dayofweek("ly_min_date"), F.lit(7))
    )
    last = F.date_sub("ly_fiscal_date", 1)
    days = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 7 DAYS")))
    measures = [c for c in facts.columns if c != LOC]
    listed = windows.withColumn("_day", F.explode(days)).withColumnRenamed(LOC, "_store")
    met = facts.join(
        listed, (F.col(LOC) == F.col("_store")) & (F.col("business_date") == F.col("_day"))
    ).select(*windows.columns, *measures)
    found = met.select(*[F.col(c).alias(f"_f{c}") for c in windows.columns]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_f{c}")) for c in windows.columns]
    alone = windows.join(found, same, "left_anti")
    return met.unionByName(alone, allowMissingColumns=True)


def without(df: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not listed (NULL keys are kept)."""
    return df.join(listed.select(*keys).distinct(), keys, "left_anti")


def not_in(df: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """SQL ``key NOT IN (listed)`` with its NULL rules.

    An empty list keeps every row, a NULL in the list removes every row, and a
    NULL key survives only an empty list.  Written as a hash anti join plus two
    scalar sub-queries, because the built-in null-aware form must broadcast the
    whole list.
    """
    values = listed.select(F.col(listed.columns[0]).alias(key)).distinct()
    summary = values.agg(
        F.struct(
            F.count(F.lit(1)).alias("total"),
            F.count(F.when(F.col(key).isNull(), 1)).alias("nulls"),
        )
    ).scalar()
    kept = df.join(values, key, "left_anti")
    return kept.where(
        (summary["total"] == 0) | ((summary["nulls"] == 0) & F.col(key).isNotNull())
    )


def padded_join(left: DataFrame, right: DataFrame, key: str = LOC) -> DataFrame:
    """Inner join of a padded ``store_number`` list with a numeric store key."""
    padded = right.withColumn("store_number", pad_store(F.col(key))).drop(key)
    return left.join(padded, "store_number")


def side_by_side(parts: list[DataFrame], key: str = LOC) -> DataFrame:
    """One row per store out of grouped aggregates of several tables."""
    first, *rest = parts
    for part in rest:
        first = first.join(part, key)
    return first


def mean_yield(ycf: DataFrame) -> DataFrame:
    return ycf.groupBy(LOC, "ingredient_id").agg(
        F.coalesce(F.avg("ycf"), F.lit(1.0)).alias("ycf")
    )


def explode_recipe(
    items: DataFrame, recipe: DataFrame, ycf: DataFrame | None, item_col: str = "product"
) -> DataFrame:
    """Item rows to ingredient rows, with the yield factor (1 where unknown)."""
    lines = recipe.select(
        F.col("pin").alias(item_col), "ingredient_id", "ingredient_quantity", "unit_of_measure"
    )
    out = items.join(lines, item_col)
    if ycf is None:
        return out.withColumn("ycf", F.lit(1.0))
    factors = ycf.select(LOC, "ingredient_id", "ycf")
    return out.join(factors, [LOC, "ingredient_id"], "left").withColumn(
        "ycf", F.coalesce("ycf", F.lit(1.0))
    )


def date_bound_check(
    df: DataFrame, run: DataFrame, first: int, last: int, key: str = LOC
) -> DataFrame:
    """Per store, whether its first and last date are run date + first / + last.

    NULL comparisons count as a match, as in the check tables.
    """
    bounds = df.groupBy(key).agg(
        F.min("business_date").alias("_min"), F.max("business_date").alias("_max")
    )
    wrong = _differs(F.col("_min"), F.date_add("run_date", first)) | _differs(
        F.col("_max"), F.date_add("run_date", last)
    )
    return bounds.join(run, key, "left").select(key, wrong.alias("wrong_dates"))


def _differs(a: Column, b: Column) -> Column:
    return F.coalesce(a != b, F.lit(False))

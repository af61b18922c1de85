"""Checks of loads and preparation: totals of one table against another."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.numeric import dec2, dsum
from tillcast.functions.text import pad_store, partition_store
from tillcast.operators.joins import side_by_side
from tillcast.operators.sets import key_difference, key_intersection
from tillcast.operators.snapshot import GENERATION, gap_stores, latest_snapshot, not_before

LOC = "location_num"
DAY = "business_date"


def any_differs(pairs: list[tuple[Column, Column]]) -> Column:
    """0 if any pair differs, else 1; a comparison with NULL counts as equal."""
    wrong = F.lit(False)
    for a, b in pairs:
        wrong = wrong | F.coalesce(a != b, F.lit(False))
    return F.when(wrong, 0).otherwise(1)


def _totals(
    df: DataFrame, measures: dict[str, str], cast_first: bool, extra: list[Column] | None = None
) -> DataFrame:
    sums = [dsum(F.col(m), cast_first).alias(name) for name, m in measures.items()]
    return df.groupBy(LOC).agg(*sums, *(extra or []))


def _newest(df: DataFrame) -> DataFrame:
    return latest_snapshot(df, keys=[LOC])


Part = tuple[DataFrame, "DataFrame | None", dict[str, str], bool]


def _folded(parts: list[Part]) -> DataFrame:
    """Totals of several tables' newest loads side by side, in one grouped pass.

    Every part is (table, its control table if there is one, total -> measure, cast first).
    Rows of all parts go into one shuffle by store, already summed per part; a store counts
    if every table has it.  The first table also gives its newest date and version.
    """
    tagged, sums, present = None, [], []
    for k, (df, control, measures, cast_first) in enumerate(parts):
        newest = latest_snapshot(df, keys=[LOC], control=control)
        rows = newest.select(
            F.lit(k).alias("_part"),
            LOC,
            *[F.col(m).alias(name) for name, m in measures.items()],
            *([DAY, GENERATION] if k == 0 else []),
        )
        tagged = rows if tagged is None else tagged.unionByName(rows, allowMissingColumns=True)
        sums += [dsum(F.col(name), cast_first).alias(name) for name in measures]
        present.append(F.max(F.col("_part") == k))
    every = present[0]
    for one in present[1:]:
        every = every & one
    loaded = [
        F.max(DAY).alias("business_date_max"),
        F.max(GENERATION).alias("dataprep_generation_date"),
    ]
    totals = tagged.groupBy(LOC).agg(*sums, *loaded, every.alias("_every"))
    return totals.where("_every").drop("_every")


def reconcile_metrics(
    daily: DataFrame,
    control_daily: DataFrame,
    m15: DataFrame,
    control_15: DataFrame,
    as_of: date,
    versions: tuple[DataFrame | None, DataFrame | None] = (None, None),
) -> DataFrame:
    """Totals of each table's newest load per store against control totals.

    ``versions`` are the control tables of newest versions of both grains.
    """
    sales, trans = "sales_sub_total", "trans_count"
    by_day, by_interval = versions
    joined = _folded(
        [
            (daily, by_day, {"sales_daily": sales, "trans_daily": trans}, False),
            (control_daily, by_day, {"sales_daily_qc": sales, "trans_daily_qc": trans}, True),
            (m15, by_interval, {"sales_15min": sales, "trans_15min": trans}, False),
            (control_15, by_interval, {"sales_15min_qc": sales, "trans_15min_qc": trans}, True),
        ]
    )
    pairs = [
        (F.col(f"{m}_{g}"), F.col(f"{m}_{g}_qc"))
        for g in ("daily", "15min")
        for m in ("sales", "trans")
    ]
    return joined.withColumn("dailyqc", any_differs(pairs)).withColumn(
        "generation_date", F.lit(as_of)
    )


def reconcile_items(
    daily: DataFrame,
    control_daily: DataFrame,
    i15: DataFrame,
    control_15: DataFrame,
    as_of: date,
    versions: tuple[DataFrame | None, DataFrame | None] = (None, None),
) -> DataFrame:
    """Same for items; each grain is compared with the control of the other."""
    qty = "sum_daily_quantity"
    by_day, by_interval = versions
    joined = _folded(
        [
            (daily, by_day, {"quantity_daily": qty}, False),
            (control_daily, by_day, {"quantity_daily_qc": qty}, False),
            (i15, by_interval, {"quantity_15min": qty}, False),
            (control_15, by_interval, {"quantity_15min_qc": qty}, False),
        ]
    )
    pairs = [
        (F.col("quantity_daily"), F.col("quantity_15min_qc")),
        (F.col("quantity_15min"), F.col("quantity_daily_qc")),
    ]
    return joined.withColumn("dailyqc", any_differs(pairs)).withColumn(
        "generation_date", F.lit(as_of)
    )


def _at_version_of(df: DataFrame, daily: DataFrame) -> DataFrame:
    """Rows of the newest version of another table, per store."""
    newest = daily.groupBy(LOC).agg(F.max(GENERATION).alias(GENERATION))
    recent = not_before(df, GENERATION, newest, GENERATION)
    return recent.join(newest, [LOC, GENERATION], "left_semi")


def prep_check_metrics(
    initial: DataFrame, final: DataFrame, initial_15: DataFrame, final_15: DataFrame, as_of: date
) -> DataFrame:
    """Totals before and after preparation, at the daily tables' newest versions."""
    sales, trans = "sales_sub_total", "trans_count"

    def named(tag: str) -> dict[str, str]:
        return {f"sales_{tag}": sales, f"trans_{tag}": trans}

    joined = side_by_side(
        [
            _totals(
                _newest(initial),
                named("daily_initial"),
                False,
                [F.max(GENERATION).alias("dataprep_generation_date")],
            ),
            _totals(
                _newest(final),
                named("daily_final"),
                False,
                [F.max("business_date").alias("business_date_max")],
            ),
            _totals(_at_version_of(initial_15, initial), named("15min_initial"), False),
            _totals(_at_version_of(final_15, final), named("15min_final"), False),
        ]
    )
    pairs = [
        (F.col(f"{m}_{g}_initial"), F.col(f"{m}_{g}_final"))
        for g in ("daily", "15min")
        for m in ("sales", "trans")
    ]
    return joined.withColumn("dailyqc", any_differs(pairs)).withColumn(
        "generation_date", F.lit(as_of)
    )


def prep_check_items(
    initial: DataFrame, final: DataFrame, initial_15: DataFrame, final_15: DataFrame, as_of: date
) -> DataFrame:
    """Same for items; both grains must agree, and no 15-minute rows count as 0."""
    qty = "sum_daily_quantity"
    joined = side_by_side(
        [
            _totals(
                _newest(initial),
                {"quantity_daily_initial": qty},
                False,
                [F.max(GENERATION).alias("dataprep_generation_date")],
            ),
            _totals(_at_version_of(initial_15, initial), {"quantity_15min_initial": qty}, False),
            _totals(
                _newest(final),
                {"quantity_daily_final": qty},
                False,
                [F.max("business_date").alias("business_date_max")],
            ),
        ]
    ).join(
        _totals(_at_version_of(final_15, final), {"quantity_15min_final": qty}, False), LOC, "left"
    )
    zero = dec2(F.lit(0))
    pairs = [
        (F.col("quantity_daily_initial"), F.col("quantity_daily_final")),
        (F.col("quantity_15min_initial"), F.coalesce("quantity_15min_final", zero)),
        (F.col("quantity_15min_initial"), F.col("quantity_daily_initial")),
    ]
    return joined.withColumn("dailyqc", any_differs(pairs)).withColumn(
        "generation_date", F.lit(as_of)
    )


def ingredient_checks(
    ycf: DataFrame, recipe: DataFrame, forecast: DataFrame, intervals: int = 96
) -> DataFrame:
    """One row of 0/1 failures: duplicate yield or recipe rows, missing intervals, wrong counts."""
    yields, lines = latest_snapshot(ycf), latest_snapshot(recipe)
    newest = latest_snapshot(forecast)

    def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.groupBy(*keys).count().where("count > 1").agg(F.count(F.lit(1)))

    per_series = newest.groupBy(LOC, "business_date", "ingredient_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    seen = newest.agg(F.countDistinct("interval_start_time"))
    wrong = per_series.agg(
        F.count(F.when(F.col("n") != intervals, 1)).alias("_wrong"),
    )

    def failed(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    return wrong.select(
        failed(repeated(yields, [LOC, "ingredient_id"]).scalar() > 0).alias("yield_not_unique"),
        failed(repeated(lines, lines.columns).scalar() > 0).alias("recipe_not_unique"),
        failed(seen.scalar() != intervals).alias("intervals_missing"),
        failed(F.col("_wrong") > 0).alias("rows_unexpected"),
    ).withColumn(
        "failed",
        F.greatest("yield_not_unique", "recipe_not_unique", "intervals_missing", "rows_unexpected"),
    )


def reset_check(staging: DataFrame, expected: DataFrame, recipe: DataFrame) -> DataFrame:
    """Staging and expected products empty, and exactly one recipe snapshot."""
    counts = staging.agg(F.count(F.lit(1)).alias("staging_rows")).select(
        "staging_rows",
        expected.agg(F.count(F.lit(1))).scalar().alias("expected_rows"),
        recipe.agg(F.countDistinct(GENERATION)).scalar().alias("recipe_snapshots"),
    )
    clean = (
        (F.col("staging_rows") == 0)
        & (F.col("expected_rows") == 0)
        & (F.col("recipe_snapshots") == 1)
    )
    return counts.withColumn("status", F.when(clean, "Success").otherwise("Failed"))


def new_locations(entries: DataFrame, known: DataFrame, col: str = "entry") -> DataFrame:
    """Stores named in partition texts that are not known yet."""
    found = entries.select(partition_store(F.col(col)).alias(LOC)).where(F.col(LOC).isNotNull())
    return key_difference(found, known, [LOC])


def rebuild_locations(location_list: DataFrame, added: DataFrame) -> dict[str, DataFrame]:
    """The list with new stores as baseline, in its three published projections."""
    grown = location_list.select(LOC, "forecast_type").unionByName(
        added.select(LOC, F.lit("baseline").alias("forecast_type"))
    )
    full = grown.select(pad_store(F.col(LOC)).alias(LOC), "forecast_type").orderBy(
        F.desc("forecast_type"), F.asc(LOC)
    )
    renamed = full.withColumnRenamed(LOC, "store_number")
    return {"baseline": full, "model": renamed, "fallback": renamed.select("store_number")}


def checked_stores(
    checks: DataFrame, known: DataFrame, loads: DataFrame, gap_loads: DataFrame, days: int = 15
) -> DataFrame:
    """Newest verdicts of known stores in the newest load, without stale reloads."""
    newest = latest_snapshot(loads).select(LOC).distinct()
    return (
        latest_snapshot(checks)
        .select(LOC, "dailyqc")
        .join(known.select(LOC).distinct(), LOC, "left_semi")
        .join(newest, LOC, "left_semi")
        .join(gap_stores(gap_loads, days), LOC, "left_anti")
        .distinct()
    )


def runnable_stores(metric_verdicts: DataFrame, item_verdicts: DataFrame) -> DataFrame:
    """Padded numbers of the stores that passed in both families."""

    def passed(v: DataFrame) -> DataFrame:
        return v.where(F.col("dailyqc") == 1)

    both = key_intersection(passed(metric_verdicts), passed(item_verdicts), [LOC])
    return both.select(pad_store(F.col(LOC)).alias("store_number"))


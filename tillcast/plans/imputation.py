"""Repairs of a model-input series before scoring.

A series is one store (and product) with at most a few hundred calendar days,
so its windows are small whatever the size of the facts behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.operators.predicates import first_rows, regular_history

LOC = "location_num"
HEAD = 56
SOLD = 0.001  # fixed value: below this a day counts as without sales
FENCE = 1.5
FUTURE, BLOCK = 32, 25


def impute_zeros(df: DataFrame, keys: list[str], metric: str, head: int = HEAD) -> DataFrame:
    """Zeros on regular past days become the weekday's median of positive days."""
    rows = first_rows(df, keys, head)
    regular = F.col("_head") & (F.col("dayofweek") != 7) & (F.col("holiday") == 0)
    value = F.col(metric).cast("double")
    by_weekday = Window.partitionBy(*keys, "dayofweek")
    typical = F.median(F.when(regular & (value > SOLD), value)).over(by_weekday)
    return (
        rows.withColumn("_typical", typical)
        .withColumn(
            metric,
            F.coalesce(
                F.when(regular & (value < SOLD), F.col("_typical")).otherwise(value), F.lit(0.0)
            ),
        )
        .drop("_row", "_head", "_typical")
    )


def _history(
    df: DataFrame, keys: list[str], metric: str, sat_off: DataFrame, head: int
) -> DataFrame:
    """Adds ``_x``, the metric on regular days of the head, and ``_any``."""
    rows = regular_history(first_rows(df, keys, head), sat_off)
    x = F.when(F.col("_head") & F.col("_regular"), F.col(metric).cast("double"))
    return rows.withColumn("_x", x).withColumn(
        "_any", F.max("_x").over(Window.partitionBy(*keys)) > SOLD
    )


def _quartile(share: float, window) -> Column:
    return F.percentile(F.col("_x"), F.lit(share)).over(window)


def _fenced(df: DataFrame, window) -> DataFrame:
    """Adds the limits and ``_outlier`` for regular days outside them."""
    df = df.withColumns({"_q1": _quartile(0.25, window), "_q3": _quartile(0.75, window)})
    spread = F.col("_q3") - F.col("_q1")
    df = df.withColumns(
        {
            "lower_limit": F.col("_q1") - F.lit(FENCE) * spread,
            "upper_limit": F.col("_q3") + F.lit(FENCE) * spread,
        }
    )
    outside = (F.col("_x") < F.col("lower_limit")) | (F.col("_x") > F.col("upper_limit"))
    return df.withColumn("_outlier", F.coalesce(F.col("_any") & outside, F.lit(False)))


_HELPERS = [
    "_row", "_head", "_regular", "_x", "_any", "_q1", "_q3", "lower_limit", "upper_limit",
    "_outlier", "_inliers", "_median", "_fallback",
]


def impute_outliers(
    df: DataFrame, keys: list[str], metric: str, sat_off: DataFrame, head: int = HEAD
) -> DataFrame:
    """Outliers against fences over all regular days become a weekday median.

    The median is that of the weekday's inliers, or of all its regular days
    when it has no inlier.
    """
    fenced = _fenced(_history(df, keys, metric, sat_off, head), Window.partitionBy(*keys))
    by_weekday = Window.partitionBy(*keys, "dayofweek")
    inlier = F.when(~F.col("_outlier"), F.col("_x"))
    medians = fenced.withColumns(
        {
            "_inliers": F.median(inlier).over(by_weekday),
            "_median": F.median("_x").over(by_weekday),
        }
    )
    value = F.when(F.col("_outlier"), F.coalesce("_inliers", "_median")).otherwise(
        F.col(metric).cast("double")
    )
    return medians.withColumn(metric, value).drop(*_HELPERS)


def impute_outliers_by_weekday(
    df: DataFrame, keys: list[str], metric: str, sat_off: DataFrame, head: int = HEAD
) -> tuple[DataFrame, DataFrame]:
    """Same with fences per weekday; also the audit rows of replaced values."""
    by_weekday = Window.partitionBy(*keys, "dayofweek")
    fenced = _fenced(_history(df, keys, metric, sat_off, head), by_weekday)
    inlier = F.when(~F.col("_outlier"), F.col("_x"))
    medians = fenced.withColumns(
        {
            "_median": F.median(inlier).over(by_weekday),
            "_fallback": F.median(inlier).over(Window.partitionBy(*keys)),
        }
    )
    actual = F.col(metric).cast("double")
    replaced = F.when(F.col("_outlier"), F.coalesce("_median", "_fallback")).otherwise(actual)
    audit = medians.where("_outlier").select(
        *keys,
        "business_date",
        "dayofweek",
        F.col("_median").alias("median"),
        "lower_limit",
        "upper_limit",
        actual.alias("actuals"),
        F.col("_median").alias("imputed_actuals"),
    )
    return medians.withColumn(metric, replaced).drop(*_HELPERS), audit


def backfill_gap(
    df: DataFrame,
    keys: list[str],
    metric: str,
    head: int = HEAD,
    future: int = FUTURE,
    block: int = BLOCK,
) -> DataFrame:
    """Copies history over the days a remodelled store was closed.

    A series longer than ``head + future`` has a gap.  The last days before the
    horizon, at most ``block``, take the values of the stretch of history that
    ends on the same weekday.  The copy is a self join on the shifted date.
    """
    whole = Window.partitionBy(*keys)
    rows = first_rows(df, keys, head).withColumns(
        {
            "_gap": F.least(F.count(F.lit(1)).over(whole) - (head + future), F.lit(block)),
            "_target_end": F.date_sub(F.max("business_date").over(whole), future),
        }
    )
    on_weekday = F.col("_head") & (
        F.weekday("business_date") == F.weekday(F.col("_target_end"))
    )
    source_end = F.max(F.when(on_weekday, F.col("business_date"))).over(whole)
    rows = rows.withColumn("_source_end", source_end).withColumn(
        "_from", F.date_sub("business_date", F.datediff("_target_end", "_source_end"))
    )
    source = df.select(
        *keys, F.col("business_date").alias("_from"), F.col(metric).alias("_copied")
    )
    in_gap = (
        (F.col("_gap") > 0)
        & (F.col("business_date") <= F.col("_target_end"))
        & (F.col("business_date") > F.date_sub("_target_end", F.col("_gap").cast("int")))
    )
    return (
        rows.join(source, [*keys, "_from"], "left")
        .withColumn(
            metric, F.when(in_gap, F.col("_copied")).otherwise(F.col(metric))
        )
        .select(*df.columns)
    )


# -- the whole repair in one pass ---------------------------------------------------------


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, not again wherever it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _share_of(values: Column, share: float) -> Column:
    """Interpolated quantile of a short array without nulls; null if it is empty."""
    at = (F.size(values) - 1) * F.lit(share)
    below, above = F.floor(at), F.ceil(at)

    def between(ordered: Column) -> Column:  # in the order of the built-in percentile
        low, high = (F.get(ordered, i.cast("int")) for i in (below, above))
        return F.when(below == above, low).otherwise((above - at) * low + (at - below) * high)

    return F.when(F.size(values) > 0, _let(F.array_sort(values), between))


def _per_weekday(values: Column, share: float) -> Column:
    """A quantile for each weekday 1 to 7 of an array of (dayofweek, x); null x do not count."""

    def of(day: Column) -> Column:
        mine = F.filter(values, lambda v: (v["dayofweek"] == day) & v["x"].isNotNull())
        return _let(F.transform(mine, lambda v: v["x"]), lambda xs: _share_of(xs, share))

    return F.transform(F.sequence(F.lit(1), F.lit(7)), of)


def repair_series(
    df: DataFrame,
    keys: list[str],
    metric: str,
    sat_off: DataFrame,
    head: int = HEAD,
    future: int = FUTURE,
    block: int = BLOCK,
) -> DataFrame:
    """Zeros, outliers by weekday and the gap of a rebuilt store, in one pass per series.

    The same rows as :func:`impute_zeros`, :func:`impute_outliers_by_weekday` and
    :func:`backfill_gap` one after the other.  A series is at most a few hundred calendar
    days, one row per day; it is gathered and sorted once, and every step is an
    expression over its array.  There is no window and no self join.
    """
    columns = [c for c in df.columns if c not in keys]
    own = F.struct("business_date", *[c for c in columns if c != "business_date"], "_regular")
    flagged = regular_history(df, sat_off)
    series = flagged.groupBy(*keys).agg(F.array_sort(F.collect_list(own)).alias("_rows"))
    rows = F.col("_rows")

    def given(r: Column) -> Column:
        return r[metric].cast("double")

    def open_day(r: Column, i: Column) -> Column:
        return (i < head) & (r["dayofweek"] != 7) & (r["holiday"] == 0)

    def paired(value) -> Column:
        """(dayofweek, x) of every row, x from the row and its 0-based place."""
        pair = lambda r, i: F.struct(r["dayofweek"].alias("dayofweek"), value(r, i).alias("x"))
        return F.transform(rows, pair)

    def weekday_of(seven: Column, r: Column) -> Column:
        return F.get(seven, r["dayofweek"].cast("int") - 1)

    def filled(typical: Column) -> Column:
        """The values, zeros of open days as the weekday's median of positive days."""

        def value(r: Column, i: Column) -> Column:
            zero = open_day(r, i) & (given(r) < SOLD)
            return F.coalesce(F.when(zero, weekday_of(typical, r)).otherwise(given(r)), F.lit(0.0))

        return F.transform(rows, value)

    def cleaned(values: Column) -> Column:
        """The values, outliers among regular past days as a median of inliers."""
        past = paired(lambda r, i: F.when((i < head) & r["_regular"], F.get(values, i)))
        return _let(past, lambda p: _without_outliers(p, values))

    def _without_outliers(past: Column, values: Column) -> Column:
        fences = F.struct(
            (F.array_max(F.transform(past, lambda p: p["x"])) > SOLD).alias("any"),
            _per_weekday(past, 0.25).alias("q1"),
            _per_weekday(past, 0.75).alias("q3"),
        )

        def outside(p: Column, f: Column) -> Column:
            q1, q3 = weekday_of(f["q1"], p), weekday_of(f["q3"], p)
            far = (p["x"] < q1 - FENCE * (q3 - q1)) | (p["x"] > q3 + FENCE * (q3 - q1))
            return F.coalesce(f["any"] & far, F.lit(False))

        def medians(f: Column) -> Column:
            inliers = F.filter(past, lambda p: p["x"].isNotNull() & ~outside(p, f))
            return _let(
                inliers,
                lambda found: F.struct(
                    _per_weekday(found, 0.5).alias("by_day"),
                    _let(F.transform(found, lambda p: p["x"]), lambda xs: _share_of(xs, 0.5)).alias("all"),
                ),
            )

        def replaced(f: Column, m: Column) -> Column:
            return F.transform(
                past,
                lambda p, i: F.when(
                    outside(p, f), F.coalesce(weekday_of(m["by_day"], p), m["all"])
                ).otherwise(F.get(values, i)),
            )

        return _let(fences, lambda f: _let(medians(f), lambda m: replaced(f, m)))

    def backfilled(clean: Column) -> Column:
        """The values, the days of a gap copied from the end of the history."""
        dates = F.transform(rows, lambda r: r["business_date"])
        gap = F.least(F.size(rows) - (head + future), F.lit(block))

        def copied(days: Column, end: Column, back: Column) -> Column:
            def value(r: Column, i: Column) -> Column:
                d = r["business_date"]
                inside = (gap > 0) & (d <= end) & (d > F.date_sub(end, gap))
                at = F.array_position(days, F.date_sub(d, back)).cast("int")
                return F.struct(
                    r.alias("row"),
                    F.when(inside, F.when(at > 0, F.get(clean, at - 1))).otherwise(F.get(clean, i)).alias("x"),
                )

            return F.transform(rows, value)

        def ended(days: Column) -> Column:
            end = F.date_sub(F.array_max(days), future)
            same = F.filter(days, lambda d, i: (i < head) & (F.weekday(d) == F.weekday(end)))
            bounds = F.struct(end.alias("end"), F.datediff(end, F.array_max(same)).alias("back"))
            return _let(bounds, lambda b: copied(days, b["end"], b["back"]))

        return _let(dates, ended)

    sold = paired(lambda r, i: F.when(open_day(r, i) & (given(r) > SOLD), given(r)))
    typical = _let(sold, lambda pairs: _per_weekday(pairs, 0.5))
    result = _let(typical, lambda t: _let(filled(t), lambda f: _let(cleaned(f), backfilled)))
    out = series.select(*keys, F.explode(result).alias("_r"))
    return out.select(
        *[
            F.col(c) if c in keys else F.col("_r.x").alias(c) if c == metric else F.col(f"_r.row.{c}").alias(c)
            for c in df.columns
        ]
    )

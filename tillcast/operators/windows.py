"""Window steps over short series (one store, one prediction date or item)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def recent_same_weekday(
    df: DataFrame, keys: list[str], weeks: str = "lookup_weeks", most_weeks: int = 9
) -> DataFrame:
    """The most recent days per key, one fewer than the lookup weeks (rank, ties kept).

    ``most_weeks`` bounds the column, nine as the setting has one digit; it is planned
    before the shuffle.  A row with more weeks fails the query rather than lose days.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("business_date"))
    over = F.raise_error(F.concat(F.lit(f"{weeks} above {most_weeks}: "), F.col(weeks).cast("string")))
    checked = F.when(F.col(weeks) > most_weeks, over.cast("int")).otherwise(F.col(weeks))
    return (
        df.withColumn("_rank", F.rank().over(newest_first))
        .where(F.col("_rank") < most_weeks)
        .where(F.col("_rank") < checked)
        .drop("_rank")
    )


def trim_extremes(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Drops every row equal to its key's minimum or maximum, ties included."""
    whole = Window.partitionBy(*keys)
    return (
        df.withColumn("_min", F.min(col).over(whole))
        .withColumn("_max", F.max(col).over(whole))
        .where((F.col(col) != F.col("_min")) & (F.col(col) != F.col("_max")))
        .drop("_min", "_max")
    )


def with_survivors(df: DataFrame, keys: list[str], name: str = "forecast_avg_dr") -> DataFrame:
    return df.withColumn(name, F.count("business_date").over(Window.partitionBy(*keys)))


def with_partition_lists(df: DataFrame, keys: list[str], cols: dict[str, str]) -> DataFrame:
    """Adds sorted lists of a column over the key's rows."""
    whole = Window.partitionBy(*keys)
    return df.withColumns(
        {name: F.array_sort(F.collect_list(col).over(whole)) for name, col in cols.items()}
    )


def supervised_frame(
    df: DataFrame,
    keys: list[str],
    features: list[str],
    n_in: int,
    n_out: int,
    order: str = "business_date",
) -> DataFrame:
    """Lagged and leading copies of every feature; rows without all of them go.

    Columns are named ``<feature>_m<k>`` for t-k, ``<feature>_t`` and
    ``<feature>_p<k>`` for t+k.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    made: dict = {}
    for k in range(n_in, 0, -1):
        made |= {f"{f}_m{k}": F.lag(f, k).over(w) for f in features}
    for k in range(n_out):
        made |= {f"{f}_p{k}" if k else f"{f}_t": F.lead(f, k).over(w) for f in features}
    return df.select(*keys, order, *[c.alias(n) for n, c in made.items()]).na.drop(
        subset=list(made)
    )

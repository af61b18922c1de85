"""Set operations on keys and frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def key_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.select(*keys).subtract(right.select(*keys))


def key_intersection(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.select(*keys).intersect(right.select(*keys))


def one_hot(df: DataFrame, col: str, vocabulary: list[str], prefix: str | None = None) -> DataFrame:
    """0/1 columns for a fixed vocabulary; a value outside it sets none."""
    prefix = prefix or col
    return df.withColumns(
        {f"{prefix}_{v}": F.when(F.col(col) == v, 1).otherwise(0) for v in vocabulary}
    )

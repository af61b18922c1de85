"""JDBC access, one partition per store.

The predicates are text built from the store keys, so the driver holds the
store list (a few thousand numbers) and never a fact row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def key_predicates(keys: list[int], template: str = "location_num = {key}") -> list[str]:
    """One WHERE text per key; keys are forced to int so no text is injected."""
    return [template.format(key=int(k)) for k in keys]


def read_jdbc_by_key(
    spark: SparkSession,
    url: str,
    table: str,
    keys: list[int],
    template: str = "location_num = {key}",
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Reads a table or a parenthesised sub-query with one connection per key."""
    return spark.read.jdbc(
        url, table, predicates=key_predicates(keys, template), properties=properties or {}
    )


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None
) -> None:
    df.write.jdbc(url, table, mode="append", properties=properties or {})

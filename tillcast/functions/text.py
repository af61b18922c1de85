"""Store numbers, setting codes and object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_store(number: Column) -> Column:
    """Five digits; a longer number passes through (plain lpad would cut it)."""
    text = number.cast("string")
    return F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)


def strip_zeros(number: Column) -> Column:
    return F.ltrim(number, F.lit("0"))


def setting_weeks(code: Column, default: int = 5) -> Column:
    return F.coalesce(F.substring(code, 1, 1).try_cast("int"), F.lit(default))


def setting_smoothing(code: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.substring(code, 7, 2).try_cast("int") / F.lit(100.0), F.lit(default))


def document_store(path: Column) -> Column:
    """Store number out of a document path (its parent folder)."""
    return F.regexp_extract(path, r"(\d{5,})/demand[-=]", 1)


def document_date(path: Column) -> Column:
    return F.to_date(F.regexp_extract(path, r"demand[-=](\d{2}-\d{2}-\d{4})", 1), "MM-dd-yyyy")


def partition_store(entry: Column) -> Column:
    """Number out of text such as ``location_num=00012``."""
    return F.regexp_extract(entry, r"=(\d+)", 1).cast("int")

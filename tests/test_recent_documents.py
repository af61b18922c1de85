"""The list of recent documents: all of them, by the time their files changed."""

from __future__ import annotations

import os
from datetime import date, datetime, timezone

from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog.views import AS_OF
from tillcast.sources import documents


def _tables(spark, path):
    """Two stores with lines on two of the days that the short documents compare with."""
    rows = [
        (order, part, 1 + part % 2, line, float(part), 1.0 + order, "R", day)
        for order, part, line, day in (
            (1, 1, 1, "2000-07-18"), (1, 2, 2, "2000-07-18"), (9, 1, 1, "2000-07-19"), (9, 2, 2, "2000-07-19"),
        )
    ]
    made = {
        "lineitem": spark.createDataFrame(
            rows,
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_returnflag string, l_shipdate string",
        ).withColumn("l_shipdate", F.to_timestamp_ntz("l_shipdate")),
        "supplier": spark.createDataFrame([(1, 0), (2, 1)], "s_suppkey long, s_nationkey int"),
        "nation": spark.createDataFrame([(0,), (1,)], "n_nationkey int"),
        "part": spark.createDataFrame(
            [(1, 1, 2000.0), (2, 2, 3000.0)], "p_partkey long, p_size int, p_retailprice double"
        ),
    }
    for name, df in made.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_recent_documents_are_all_documents(spark, tmp_path):
    got = entry.queries()["s13_recent_documents"](spark, _tables(spark, tmp_path)).collect()
    days = {r["business_date"] for r in got}
    assert days == {date(2001, 7, 17), date(2001, 7, 18)}
    assert {(r["store_number"], r["business_date"]) for r in got} == {
        (store, day) for store in ("00001", "00002") for day in days
    }
    assert "min(" not in entry.oracle_sql()["s13_recent_documents"]


def test_documents_changed_before_the_bound_are_not_listed(spark, tmp_path):
    for day, changed in (
        ("07-17-2001", datetime(2001, 6, 18, 23, 59, 59, tzinfo=timezone.utc)),
        ("07-18-2001", datetime(2001, 6, 19, 0, 0, 1, tzinfo=timezone.utc)),
    ):
        folder = tmp_path / "store_folder=00001" / f"demand={day}"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text("{}")
        os.utime(folder / "a.json", (changed.timestamp(), changed.timestamp()))
    got = documents.list_documents(spark, str(tmp_path), AS_OF).collect()
    assert [tuple(r) for r in got] == [("00001", date(2001, 7, 18))]

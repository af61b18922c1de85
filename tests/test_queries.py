"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    columns, rows = spark_rows(df)
    if name not in ORACLES:
        assert len(set(columns)) == len(columns)
        return
    assert (columns, rows) == sql_rows(con, ORACLES[name])


def test_flagship_covers_every_store_date_and_interval(spark):
    assert entry.entry(spark).count() == 25 * 8 * 96

"""Registered queries against DuckDB on the smallest data set, and properties of their plans."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
ORACLES = sorted(entry.oracle_sql())
# Rows-only queries that fit models are covered by their own tests on small frames.
MAY_BE_EMPTY = {
    "stuck_stations", "stuck_stations_half_hour", "stuck_table", "top_stuck_stations", "unresolved_anomalies",
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_oracle(spark, con, name):
    ok, note = compare(name, spark, con, SF)
    assert ok or (name in MAY_BE_EMPTY and note == "no rows"), note


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["build_features", "feature_drift", "station_activity", "dq_report"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

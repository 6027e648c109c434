"""Every named query against its SQL on the smallest tables, and the shape of its plan."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from check import rows_of
from hourloom.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Models have no SQL equivalent; their rows are checked in test_boosting.
ROWS_ONLY = {
    "feature_importances",
    "gbt_cv",
    "gbt_early_stop",
    "gbt_predict",
    "refresh_and_train",
    "train_pipeline",
}
# A whole-frame report ends in one row per check or column.
GLOBAL_REPORTS = {"dq_suite_warehouse", "dq_suite_model_input", "dq_suite_two_keys", "table_summary"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_the_driver_sees_every_query():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = [tuple(row) for row in df.collect()]
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    want = result.fetchall()
    assert got, "a query over these tables has rows"
    assert rows_of(df.columns, got) == rows_of(columns, want)


#: How often a plan may scan a given table.
SCANS = {"baseline_cv": 4, "impute_month_hour": 4, "demand_features": 4, "regression_metrics": 6, "histogram": 2, "trailing_window": 2}


@pytest.mark.parametrize("name", sorted(SCANS))
def test_lookups_do_not_repeat_their_input(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan parquet") <= SCANS[name]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_plan_scales(spark, name):
    """No pairing of all rows, no Python in the plan, no gathering of rows into one task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan
    if name not in GLOBAL_REPORTS:
        assert "Exchange SinglePartition" not in plan


def test_entry(spark):
    df = driver.entry(spark)
    assert {"series_id", "ts", "d", "hour", "is_holiday"} <= set(df.columns)
    assert df.count() > 0


def test_sketch_quantiles_broadcasts_no_quantiles(spark):
    plan = QUERIES["sketch_quantiles"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan

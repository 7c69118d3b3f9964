"""Every registered query against its SQL, and the plans they run on."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import DataFrame

import __spark_entry__
from registry import ORACLES, QUERIES
from tools.check import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = plan_text(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    _, wrong = difference(con, ORACLES[name], df)
    assert wrong is None, wrong


@pytest.mark.parametrize("name", ["c08_asof_join", "c08_asof_two_clocks", "c15_forward_outcome", "e01_key_order", "e04_latency_disorder",
                                  "e16_warm", "f02_canonical_order", "k03_scan_members", "c14_event_window_totals", "b02_check_inventory", "c09_phase_conflict"])
def test_split_keys_give_the_same_rows(split, con, name):
    _, wrong = difference(con, ORACLES[name], QUERIES[name](split, SF))
    assert wrong is None, wrong


def test_queries_without_sql_run(spark):
    assert sorted(set(QUERIES) - set(ORACLES)) == ["a01_file_inventory"]
    assert QUERIES["a01_file_inventory"](spark, SF).first().n_files == 14


def test_entry_points(spark):
    assert __spark_entry__.entry(spark).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_bounded_scan_reaches_the_files(spark):
    plan = plan_text(QUERIES["a06_scan_bounded"](spark, SF))
    assert "EqualTo(event_type,view)" in plan and "GreaterThanOrEqual(ts" in plan and "props" not in plan


def test_top_n_is_limited_before_the_shuffle(spark):
    plan = plan_text(QUERIES["f01_latest_n"](spark, SF))
    assert plan.count("WindowGroupLimit") == 2

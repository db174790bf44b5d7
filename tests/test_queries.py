"""Every registered query against its SQL, and the plans of the batch queries."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_queries  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from vigilspark.plans.catalog import all_queries  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The text queries have tests of their own.
QUERIES = {name: build for name, build in entry.queries().items() if name in all_queries()}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def db():
    return check_queries.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    assert check_queries.compare(spark, db, FOLDER, name, QUERIES[name], ORACLES[name]).startswith("ok")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert {r.alert_level for r in entry.entry(spark).collect()} == {"HIGH", "MEDIUM", "LOW"}


PLANNED = [
    "rule_alert_level", "clean_reports", "features_v1", "features_v2", "topn_drug", "flatten_first",
    "balanced_sample", "target_counts", "risk_profile", "missing_by_column", "insights", "recent_alerts", "system_stats",
    "orphan_alerts", "minute_summary", "running_minute_summary", "stratified_split", "clean_trials", "ascii_clean",
]


@pytest.mark.parametrize("name", PLANNED)
def test_plan_has_no_pairwise_join_and_no_python(spark, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert operator not in plan


def test_filters_reach_the_scan(spark):
    from pyspark.sql import functions as F

    from vigilspark.operators import filters

    reports = spark.read.parquet(f"{FOLDER}/orders.parquet").select(
        F.col("o_orderstatus").alias("receivedate"), "o_orderkey", "o_totalprice")
    plan = filters.filter_receive_window(reports, "A", "F").select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderstatus,A)" in plan and "o_totalprice" not in plan.split("ReadSchema")[1]


def test_fallback_pushes_its_window_and_drops_the_second_scan(spark):
    df = QUERIES["fetch_with_fallback"](spark, FOLDER)
    rows = len(df.collect())
    assert 0 < rows < spark.read.parquet(f"{FOLDER}/orders.parquet").count()


def test_dictionary_stands_once_in_the_training_plan(spark):
    plan = QUERIES["features_v2"](spark, FOLDER)._jdf.queryExecution().analyzed().toString()
    assert plan.count("scalar-subquery") <= 2

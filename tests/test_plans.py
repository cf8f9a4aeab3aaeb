"""Physical plans: what must reach the scan, and what must never appear."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from conftest import SF
from tidemark.operators.activity import sliding_distinct
from tidemark.plans import marts
from tidemark.sources.sinks import overwrite_partitions
from workload.fixtures import AS_OF, events

QUERIES = [
    "dau_mau",
    "retention_cohorts",
    "conversion_funnel",
    "user_segmentation",
    "user_deciles",
    "scd2_history",
    "pit_join",
    "load_fact_events",
    "load_fact_orders",
    "product_lookup",
    "surrogate_keys",
    "dq_suite",
    "dq_relationships",
]


@pytest.fixture(autouse=True)
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", False)
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_nested_loops_and_no_python(spark, name):
    plan = _plan(driver.queries()[name](spark, SF))
    for unwanted in ("CartesianProduct", "NestedLoop", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert unwanted not in plan


def _single_task_windows(plan):
    """Operators right below each exchange to a single task that feeds a window."""
    lines = [line.lstrip(" :+-*|").lstrip("()0123456789 ") for line in plan.splitlines()]
    found = []
    for i, line in enumerate(lines):
        if line.startswith("Exchange SinglePartition"):
            above = lines[max(0, i - 2) : i]
            if any(a.startswith("Window") for a in above):
                found.append(lines[i + 1 : i + 4])
    return found


@pytest.mark.parametrize("name", QUERIES)
def test_one_task_windows_only_see_aggregates(spark, name):
    for below in _single_task_windows(_plan(driver.queries()[name](spark, SF))):
        assert any("HashAggregate" in line or "Generate" in line or "Union" in line for line in below)


def test_mart_dates_reach_the_scan(spark):
    plan = _plan(marts.dau_mau(events(spark, SF), AS_OF))
    scan = plan[plan.index("FileScan parquet") :]
    assert "GreaterThanOrEqual(ts" in scan and "LessThan(ts" in scan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in scan


def test_stickiness_shuffles_users_once(spark):
    df = sliding_distinct(events(spark, SF), AS_OF, AS_OF, 30, daily_name="dau")
    plan = _plan(df)
    assert plan.count("Exchange hashpartitioning(user_id") == 1
    assert plan.count("FileScan") == 1


def test_funnel_reads_and_shuffles_events_once(spark):
    plan = _plan(marts.funnel_step_times(events(spark, SF)))
    assert plan.count("FileScan") == 1 and "Join" not in plan
    assert plan.count("Exchange hashpartitioning(user_id") == 2
    assert plan.count("Exchange") == 2
    # Below the second one lies a row per key and slot.
    below = plan[plan.rindex("Exchange hashpartitioning", 0, plan.rindex("Exchange hashpartitioning")) :]
    assert "HashAggregate(keys=[user_id" in below or "SortAggregate(key=[user_id" in below


def test_partitioned_facts_prune_days(spark, folder):
    path = folder("facts")
    overwrite_partitions(events(spark, SF), path, "event_date", sort_col="event_timestamp")
    plan = _plan(marts.user_activity(
        spark.createDataFrame([], "user_id string, country string, preferred_platform string, is_current boolean"),
        spark.read.parquet(path),
        spark.read.parquet(path).select(
            "event_id", F.col("event_date").alias("order_date"), F.col("amount").alias("order_amount")
        ),
        AS_OF,
    ))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("PartitionFilters: [isnotnull(event_date" in line for line in scans)


def test_catalogue_is_broadcast_without_a_shuffle_of_events(spark):
    plan = _plan(driver.queries()["product_lookup"](spark, SF))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan

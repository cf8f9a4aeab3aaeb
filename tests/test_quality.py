import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.quality import DataQualityError
from tidemark.schemas import EVENT_TYPES, UUID_PATTERN


@pytest.fixture
def clean(spark):
    return spark.range(100).select(
        F.concat(F.lit("evt_"), F.col("id").cast("string")).alias("event_id"),
        F.concat(F.lit("usr_"), F.col("id").cast("string")).alias("user_id"),
        F.lit("login").alias("event_type"),
        F.lit("2026-10-06 12:00:00").cast("timestamp_ntz").alias("event_timestamp"),
        F.lit(0.0).alias("amount"),
    )


def test_suite_passes_on_clean_rows(clean):
    rows = quality.event_suite(clean, floor=100).collect()
    assert len(rows) == 8
    assert all(r.passed and r.checks_passed and r.total_records == 100 for r in rows)
    assert len(quality.event_suite(clean).collect()) == 7


def test_suite_reports_each_fault(clean):
    faults = clean.limit(1).select(
        F.lit(None).cast("string").alias("event_id"),
        "user_id",
        F.lit(None).cast("string").alias("event_type"),
        "event_timestamp",
        F.lit(-1.0).alias("amount"),
    )
    rows = quality.event_suite(clean.unionByName(faults).unionByName(faults), floor=103).collect()
    got = {r.check.split(":")[0] + r.check[-10:]: r.failing_rows for r in rows}
    assert not rows[0].checks_passed
    assert sorted(got.values()) == [0, 0, 1, 1, 2, 2, 2, 2]


def test_suite_of_no_rows(clean):
    rows = quality.event_suite(clean.where(F.lit(False))).collect()
    assert len(rows) == 7
    assert all(r.passed and r.total_records == 0 for r in rows)


def test_null_rules_of_uniqueness(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string")
    assert quality.duplicate_keys(df, ["k"]).count() == 1
    assert quality.duplicate_keys(df, ["k"], nulls="value").count() == 2
    assert quality.duplicate_count(df, "k").first().duplicates == 3


def test_unexpected_values(spark):
    df = spark.createDataFrame([("login",), ("share",), ("share",), (None,)], "t string")
    assert quality.unexpected_values(df, "t", EVENT_TYPES).collect() == [("share", 2)]
    assert quality.unexpected_values(df, "t", EVENT_TYPES, null_is_invalid=True).count() == 2


def test_range_lets_unknown_pass(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "amount double")
    assert quality.violations(df, F.col("amount") >= 0).count() == 1


def test_orphans(spark):
    facts = spark.createDataFrame([(1,), (2,), (2,), (None,)], "user_sk int")
    dim = spark.createDataFrame([(1,)], "user_sk int")
    assert quality.orphans(facts, dim, "user_sk").collect() == [(2, 2)]


@pytest.mark.parametrize(
    ("hours", "status"), [(0, "pass"), (12, "pass"), (12.01, "warn"), (24, "warn"), (24.01, "error")]
)
def test_freshness_bounds(clean, hours, status):
    now = datetime.datetime(2026, 10, 6, 12) + datetime.timedelta(hours=hours)
    assert quality.freshness(clean, now).first().status == status


def test_no_rows_are_not_fresh(clean):
    now = datetime.datetime(2026, 10, 6, 12)
    assert quality.freshness(clean.where(F.lit(False)), now).first().status == "error"


def test_drift_skips_the_first_day_and_flags_jumps(spark):
    counts = [10, 10, 10, 20, 10]
    rows = [
        (datetime.date(2024, 1, i + 1),) for i, n in enumerate(counts) for _ in range(n)
    ]
    df = spark.createDataFrame(rows, "event_date date")
    got = quality.row_count_drift(df).collect()
    assert [(r.event_date.day, r.baseline_7d_avg) for r in got] == [(4, 10.0)]


def test_gate(clean):
    assert set(quality.gate(clean).values()) == {0}
    with pytest.raises(DataQualityError, match="duplicate_keys=100"):
        quality.gate(clean.union(clean), "twice")
    broken = clean.withColumn("user_id", F.lit(None).cast("string"))
    with pytest.raises(DataQualityError, match="missing_required=100"):
        quality.gate(broken)


def test_text_limits(spark):
    rows = [("6f1c2d3e-0000-4000-8000-00000000abcd", "US"), ("evt_1", "LONGER"), (None, None)]
    df = spark.createDataFrame(rows, "event_id string, country string")
    got = quality.text_limits(df, {"country": 4}, {"event_id": UUID_PATTERN}).collect()
    assert [(r.check, r.failing_rows) for r in got] == [
        ("max_length: country", 1),
        ("pattern: event_id", 1),
    ]


def test_suite_lists_all_unexpected_values_or_says_how_many_more(clean, monkeypatch):
    kinds = F.concat(F.lit("kind"), F.lpad((F.col("event_id").cast("string")), 5, "0"))
    odd = clean.withColumn("event_type", F.when(F.col("event_id").isNotNull(), kinds))
    n = odd.select("event_type").distinct().count()

    def message():
        check = "expect_column_values_to_be_in_set: event_type"
        row = quality.event_suite(odd).where(F.col("check") == check).first()
        assert row.failing_rows == odd.count()
        return row.message

    listed = sorted(r[0] for r in odd.select("event_type").distinct().collect())
    assert message() == "Unexpected event types: {" + ", ".join(listed) + "}"
    monkeypatch.setattr(quality, "_SHOWN", 2)
    assert message() == "Unexpected event types: {" + ", ".join(listed[:2]) + "}" + f" and {n - 2} more"

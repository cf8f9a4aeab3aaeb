import datetime
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.functions import json_contains, json_text, product_number, utc_timestamp
from tidemark.schemas import DEFAULTS, DIM_USER, conform
from tidemark.sources.events import partition_inventory, read_day, read_events, read_raw
from tidemark.sources.scratch import scratch_root
from tidemark.sources.sinks import overwrite_partitions, write_json_lake, write_parquet_lake


def _foreign_file(root, day, name, products):
    """A file of another writer, whose all-NULL columns carry no type."""
    n = len(products)
    os.makedirs(f"{root}/date={day}", exist_ok=True)
    pq.write_table(
        pa.table(
            {
                "event_id": [f"{name}{i}" for i in range(n)],
                "user_id": ["u"] * n,
                "event_type": ["login"] * n,
                "event_timestamp": [f"{day}T10:00:00Z"] * n,
                "event_date": [day] * n,
                "platform": ["web"] * n,
                "country": ["US"] * n,
                "product_id": products,
                "amount": [0.0] * n,
                "session_id": ["s"] * n,
                "metadata": ["{}"] * n,
            }
        ),
        f"{root}/date={day}/events_{name}.parquet",
    )


def test_untyped_product_files_are_read(spark, folder):
    root = folder("foreign")
    _foreign_file(root, "2024-01-01", "a", [None, None])
    _foreign_file(root, "2024-01-01", "b", ["PRD_0001", None])
    _foreign_file(root, "2024-01-02", "c", [None])
    _foreign_file(root, "2024-01-03", "d", ["PRD_0002"])
    rows = read_events(spark, root, typed=False).select("event_id", "product_id").collect()
    assert sorted((r.event_id, r.product_id) for r in rows) == [
        ("a0", None),
        ("a1", None),
        ("b0", "PRD_0001"),
        ("b1", None),
        ("c0", None),
        ("d0", "PRD_0002"),
    ]
    one_day = read_raw(spark, root, days=["2024-01-02"], typed=False)
    assert [r.event_id for r in one_day.collect()] == ["c0"]


def test_missing_day_is_empty(spark, folder, staged):
    root = folder("lake")
    write_parquet_lake(staged([("u", "login", "2024-01-01 10:00:00")]), root)
    assert read_day(spark, root, "2024-01-02").count() == 0
    assert read_day(spark, root, "2024-01-01").count() == 1


def test_one_day_read_prunes_partitions(spark, folder, staged):
    root = folder("lake")
    write_parquet_lake(staged([("u", "login", f"2024-01-0{d} 10:00:00") for d in (1, 2, 3)]), root)
    plan = read_day(spark, root, "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_append_adds_files_to_a_day(spark, folder, staged):
    root = folder("lake")
    for hour in (10, 11):
        write_parquet_lake(staged([("u", "login", f"2024-01-01 {hour}:00:00")]), root)
    row = partition_inventory(spark, root).first()
    assert (row.n_files, row.n_rows) == (2, 2)


def test_formats_agree(spark, folder, staged):
    events = staged(
        [
            ("u", "login", "2024-01-01 10:00:00", {"event_id": "a", "metadata": '{"k":"v"}'}),
            ("v", "purchase", "2024-01-02 10:00:00.250000",
             {"event_id": "b", "product_id": "PRD_0003", "amount": 9,
              "metadata": '{"client":{"v":1},"payment_gateway":"stripe"}'}),
        ]
    )
    parquet, json = folder("p"), folder("j")
    write_parquet_lake(events, parquet)
    write_json_lake(events, json)
    expected = sorted(map(tuple, events.collect()))
    assert sorted(map(tuple, read_events(spark, parquet).collect())) == expected
    assert sorted(map(tuple, read_events(spark, json, fmt="json").collect())) == expected


def test_struct_metadata_is_written_as_json_text(spark, folder, staged):
    root = folder("lake")
    events = staged([("u", "login", "2024-01-01 10:00:00")]).withColumn(
        "metadata", F.struct(F.lit("v1").alias("client_version"))
    )
    write_parquet_lake(events, root)
    assert read_events(spark, root).first().metadata == '{"client_version":"v1"}'


def test_overwrite_is_idempotent_and_clears_an_empty_day(spark, folder, staged):
    path = folder("table")
    two = staged([("u", "login", "2024-01-01 10:00:00"), ("u", "login", "2024-01-02 10:00:00")])
    for _ in range(2):
        overwrite_partitions(two, path, "event_date")
        assert spark.read.parquet(path).count() == 2
    first = two.where(F.col("event_date") == F.lit(datetime.date(2024, 1, 1)))
    overwrite_partitions(first, path, "event_date", ["2024-01-02", "2024-01-01", "2024-01-09"])
    left = [r.event_date for r in spark.read.parquet(path).collect()]
    assert left == [datetime.date(2024, 1, 1)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-01-01T00:00:00Z", datetime.datetime(2024, 1, 1)),
        ("2024-01-01T00:00:00.5Z", datetime.datetime(2024, 1, 1, 0, 0, 0, 500000)),
        ("2024-01-01T05:30:00+05:30", datetime.datetime(2024, 1, 1)),
        ("2024-11-03T01:30:00", datetime.datetime(2024, 11, 3, 1, 30)),
        ("not a time", None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_iso_time_does_not_depend_on_the_session_zone(spark, text, expected, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(utc_timestamp(F.col("t"))).first()[0] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_scalar_functions(spark):
    df = spark.createDataFrame(
        [('{"payment_gateway":"stripe"}', "PRD_0007"), ('{"a":1}', "bad"), (None, None)],
        "m string, p string",
    )
    rows = df.select(
        json_text(F.col("m"), "payment_gateway"),
        F.coalesce(json_contains(F.col("m"), {"payment_gateway": "stripe"}), F.lit(False)),
        product_number(F.col("p")),
    ).collect()
    assert [tuple(r) for r in rows] == [("stripe", True, 7), (None, False, None), (None, False, None)]


def test_conform_fills_defaults(spark):
    df = spark.createDataFrame([("u", None)], "user_id string, is_current boolean")
    row = conform(df, DIM_USER, DEFAULTS["dim_user"], load_ts=F.lit("now")).first()
    assert (row.user_tier, row.is_current, row.valid_to.year) == ("standard", True, 9999)
    assert row.user_sk is None
    assert row.created_at == "now"


def test_scratch_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = scratch_root(spark)
    assert root == (named.rstrip("/") if named else scratch_root(spark))

"""Compaction of small files, and checks answered by footers."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF
from tidemark.operators.quality import freshness, not_null
from tidemark.plans.file_checks import file_freshness, file_not_null, table_footers
from tidemark.sources import compaction
from tidemark.sources.compaction import compact_lake, plan_bins
from tidemark.sources.events import PARTITION, lake_footers, read_events, read_raw
from tidemark.sources.sinks import file_names, raw_rows, write_json_lake, write_parquet_lake
from workload.fixtures import events


@pytest.fixture
def rows(spark):
    return events(spark, SF).where("event_date <= '2024-01-03'")


def flushed(write, rows, root, times):
    """One small file per flush and day, as a generator leaves them."""
    for part in rows.randomSplit([1.0] * times, seed=1):
        write(part.coalesce(1), root)


def state(spark, root, fmt):
    return sorted(map(tuple, read_raw(spark, root, fmt).collect()), key=repr)


def data_files(spark, root, day):
    return {n for n in file_names(spark, f"{root}/{PARTITION}={day}") if n[0] not in "._"}


@pytest.mark.parametrize(("fmt", "write"), [("parquet", write_parquet_lake), ("json", write_json_lake)])
def test_same_rows_in_fewer_files(spark, folder, rows, fmt, write):
    root = folder("lake")
    flushed(write, rows, root, 5)
    before = state(spark, root, fmt)
    found = compact_lake(spark, root, fmt)
    assert state(spark, root, fmt) == before
    assert found == {datetime.date(2024, 1, d): (5, 1) for d in (1, 2, 3)}
    assert len(data_files(spark, root, "2024-01-02")) == 1
    # A second run finds nothing to do.
    names = data_files(spark, root, "2024-01-02")
    assert compact_lake(spark, root, fmt) == {}
    assert data_files(spark, root, "2024-01-02") == names


def test_large_files_and_other_days_stay(spark, folder, rows):
    root = folder("lake")
    write_parquet_lake(rows.coalesce(1), root)
    large = data_files(spark, root, "2024-01-01")
    flushed(write_parquet_lake, rows.where("event_id % 5 = 0"), root, 3)
    others = data_files(spark, root, "2024-01-02")
    sizes = sorted(r.length for r in lake_footers(spark, root, ["2024-01-01"]).collect())
    before = state(spark, root, "parquet")
    found = compact_lake(spark, root, days=["2024-01-01"], target=2 * sizes[-1])
    assert found == {datetime.date(2024, 1, 1): (3, 1)}
    assert large < data_files(spark, root, "2024-01-01")
    assert data_files(spark, root, "2024-01-02") == others
    assert state(spark, root, "parquet") == before


def test_bins_are_filled_in_order(spark):
    files = [(f"f{i:02}", size, "d") for i, size in enumerate([40, 45, 30, 20, 49, 10, 60, 5])]
    bins = plan_bins(spark.createDataFrame(files, f"path string, length long, {PARTITION} string"), 100)
    assert sorted((r.path, r.bin) for r in bins.collect()) == [
        ("f00", 0), ("f01", 0), ("f02", 0), ("f03", 1), ("f04", 1), ("f05", 1), ("f07", 1)
    ]


@pytest.mark.parametrize("step", ["rename_path", "delete_path"])
def test_a_run_that_broke_off_is_finished(spark, folder, rows, monkeypatch, step):
    root = folder("lake")
    flushed(write_parquet_lake, rows, root, 3)
    before = state(spark, root, "parquet")
    real, calls = getattr(compaction, step), []

    def breaks(*args):
        calls.append(args)
        if len(calls) == 3:
            raise OSError("broke off")
        return real(*args)

    monkeypatch.setattr(compaction, step, breaks)
    with pytest.raises(OSError, match="broke off"):
        compact_lake(spark, root)
    monkeypatch.setattr(compaction, step, real)
    compact_lake(spark, root)
    assert state(spark, root, "parquet") == before
    assert len(data_files(spark, root, "2024-01-03")) == 1
    assert "_compaction" not in file_names(spark, root)


def test_compaction_gives_untyped_files_their_types(spark, folder, rows):
    root = folder("lake")
    raw = raw_rows(rows).withColumn(PARTITION, F.to_date("event_date"))
    likes = F.col("event_type") == "like"
    untyped = raw.where(likes).withColumn("product_id", F.lit(None).cast("int"))
    for part in (raw.where(~likes), untyped):
        part.coalesce(1).write.partitionBy(PARTITION).mode("append").parquet(root)
    before = state(spark, root, "parquet")
    compact_lake(spark, root)
    assert sorted(map(tuple, read_raw(spark, root, typed=True).collect()), key=repr) == before
    assert read_events(spark, root, typed=True).count() == len(before)


def stored(rows, root):
    rows.repartition(3).write.parquet(root)


def test_nulls_and_age_from_footers(spark, folder, rows):
    root = folder("table")
    faulty = rows.withColumn("user_id", F.when(F.col("event_id") % 7 > 0, F.col("user_id")))
    stored(faulty, root)
    columns = ["event_id", "user_id", "product_id", "event_timestamp"]
    by_check = lambda df: sorted(map(tuple, df.collect()))
    assert by_check(file_not_null(spark, root, columns)) == by_check(not_null(faulty, columns))
    now = datetime.datetime(2024, 1, 4, 9, 30)
    assert file_freshness(spark, root, now).collect() == freshness(faulty, now).collect()
    # Nothing but footers was read.
    footers = table_footers(spark, root, columns)
    assert footers.agg(F.sum("n_rows")).first()[0] == faulty.count()
    plan = file_freshness(spark, root, now)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" not in plan


def test_files_without_statistics_are_read(spark, folder, rows):
    root = folder("table")
    stored(rows.where("event_id % 2 = 0"), root)
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        later = F.timestamp_add("HOUR", F.lit(1), F.col("event_timestamp"))
        odd = rows.where("event_id % 2 = 1").withColumn("event_timestamp", later.cast("timestamp"))
        odd.coalesce(1).write.option("parquet.column.statistics.enabled", "false").mode("append").parquet(root)
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    now = datetime.datetime(2024, 1, 4, 9, 30)
    newest = odd.agg(F.max(F.col("event_timestamp").cast("timestamp_ntz"))).first()[0]
    assert file_freshness(spark, root, now).first().newest == newest


def test_a_table_without_files(spark, folder):
    root = folder("none")
    spark.range(0).coalesce(1).write.parquet(root)
    row = file_freshness(spark, root, datetime.datetime(2024, 1, 1), ts="id").first()
    assert row.status == "error"
    assert file_not_null(spark, root, ["id"]).first().passed

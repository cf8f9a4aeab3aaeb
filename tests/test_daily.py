import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import DataQualityError, declared_checks
from tidemark.operators.scd2 import interval_problems, scd2_history
from tidemark.plans import daily, marts
from tidemark.plans.warehouse import loaded_tables, register_views, snapshot_tables
from tidemark.sources.published import Publication, read_state
from tidemark.sources.sinks import delete_path, file_names, write_json_lake, write_parquet_lake


@pytest.fixture
def warehouse(spark, staged, folder):
    """Three loaded days of a few users."""
    rows = []
    for day in (1, 2, 3):
        at = f"2024-01-0{day}"
        rows += [
            ("u", "login", f"{at} 08:00:00", {"platform": "ios" if day % 2 else "web"}),
            ("u", "purchase", f"{at} 09:00:00",
             {"platform": "ios" if day % 2 else "web", "amount": 5, "product_id": "PRD_0002"}),
            ("v", "like", f"{at} 10:00:00"),
        ]
    rows.append(("w", "signup", "2024-01-03 11:00:00"))
    events = staged(rows)
    lake, path = folder("lake"), folder("warehouse")
    write_parquet_lake(events, lake)
    return events, lake, path


def _state(spark, path):
    tables = {
        "dim": daily.read_dim_user(spark, path),
        "events": daily.read_fact_events(spark, path),
        "orders": daily.read_fact_orders(spark, path),
    }
    return {k: sorted(map(tuple, t.select(sorted(t.columns)).collect())) for k, t in tables.items()}


def test_days_one_by_one_equal_a_rebuild(spark, warehouse, folder):
    events, lake, path = warehouse
    for day in (1, 2, 3):
        assert daily.run_daily(spark, lake, path, f"2024-01-0{day}") == "loaded"
    whole = folder("rebuilt")
    daily.rebuild(spark, lake, whole)
    assert _state(spark, path) == _state(spark, whole)
    assert all(r.passed for r in interval_problems(daily.read_dim_user(spark, path)).collect())
    early = daily.read_dim_user(spark, path, as_of="2024-01-02")
    want = scd2_history(events.where(F.col("event_date") <= F.lit(datetime.date(2024, 1, 2))))
    assert early.count() == want.count()


def test_rerun_changes_nothing(spark, warehouse):
    _, lake, path = warehouse
    for day in (1, 2):
        daily.run_daily(spark, lake, path, f"2024-01-0{day}")
    before = _state(spark, path)
    assert daily.run_daily(spark, lake, path, "2024-01-02") == "loaded"
    assert _state(spark, path) == before


def test_tables_answer_sql(spark, warehouse):
    _, lake, path = warehouse
    for day in (1, 2, 3):
        daily.run_daily(spark, lake, path, f"2024-01-0{day}")
    register_views(loaded_tables(spark, path), "loaded_")
    register_views(snapshot_tables(spark, lake), "snap_")
    for prefix, count in (("loaded_", 9), ("snap_", 10)):
        rows = spark.sql(
            f"""SELECT COUNT(*) AS n, COUNT(o.order_sk) AS orders, MAX(p.category) AS category
            FROM {prefix}fact_events e
            JOIN {prefix}dim_date d ON d.calendar_date = e.event_date
            LEFT JOIN {prefix}fact_orders o ON o.event_id = e.event_id
            LEFT JOIN {prefix}dim_product p ON p.product_sk = o.product_sk"""
        ).collect()
        assert [tuple(r) for r in rows] == [(count, 3, "digital_goods")]
    checks = declared_checks(loaded_tables(spark, path)).collect()
    assert len(checks) == 16 and all(c.passed for c in checks)


def test_missing_day_is_skipped(spark, warehouse):
    _, lake, path = warehouse
    assert daily.run_daily(spark, lake, path, "2024-02-01") == "missing"
    assert daily.read_fact_events(spark, path).count() == 0


def test_late_day_is_refused_or_rebuilt(spark, warehouse, folder):
    _, lake, path = warehouse
    for day in (1, 3):
        daily.run_daily(spark, lake, path, f"2024-01-0{day}")
    with pytest.raises(ValueError, match="older"):
        daily.run_daily(spark, lake, path, "2024-01-02")
    assert daily.run_daily(spark, lake, path, "2024-01-02", rebuild_if_older=True) == "rebuilt"
    whole = folder("rebuilt")
    daily.rebuild(spark, lake, whole)
    assert _state(spark, path) == _state(spark, whole)


def test_gate_stops_a_bad_day_before_it_is_published(spark, warehouse, staged):
    events, lake, path = warehouse
    daily.run_daily(spark, lake, path, "2024-01-01")
    before = _state(spark, path)
    # The same events once more make every key of the day a duplicate.
    second = events.where(F.col("event_date") == F.lit(datetime.date(2024, 1, 2)))
    write_parquet_lake(second, lake)
    with pytest.raises(DataQualityError, match="duplicate_keys=3"):
        daily.run_daily(spark, lake, path, "2024-01-02")
    assert _state(spark, path) == before


def test_rerun_of_the_newest_day_after_a_rebuild(spark, warehouse):
    _, lake, path = warehouse
    daily.rebuild(spark, lake, path)
    before = _state(spark, path)
    assert daily.run_daily(spark, lake, path, "2024-01-03") == "loaded"
    assert _state(spark, path) == before
    for day, users in (("2024-01-01", 2), ("2024-01-02", 3), ("2024-01-03", 5)):
        assert daily.read_dim_user(spark, path, as_of=day).count() == users


def test_rebuild_to_a_day_drops_what_is_later(spark, warehouse, folder):
    _, lake, path = warehouse
    daily.rebuild(spark, lake, path)
    daily.rebuild(spark, lake, path, upto="2024-01-02")
    early = folder("early")
    for day in (1, 2):
        daily.run_daily(spark, lake, early, f"2024-01-0{day}")
    assert _state(spark, path) == _state(spark, early)


def test_one_event_id_on_two_days(spark, staged, folder):
    rows = [("u", "login", f"2024-01-0{d} 08:00:00", {"event_id": "same"}) for d in (1, 2)]
    rows.append(("v", "like", "2024-01-02 09:00:00"))
    lake, path = folder("lake"), folder("by-day")
    write_parquet_lake(staged(rows), lake)
    daily.run_daily(spark, lake, path, "2024-01-01")
    before = _state(spark, path)
    with pytest.raises(DataQualityError, match="event_id_of_other_day=1"):
        daily.run_daily(spark, lake, path, "2024-01-02")
    assert _state(spark, path) == before
    # The day that has the id may come again.
    assert daily.run_daily(spark, lake, path, "2024-01-01") == "loaded"
    with pytest.raises(DataQualityError, match="duplicate_keys=1"):
        daily.rebuild(spark, lake, path)
    assert _state(spark, path) == before


def test_equal_hashes_of_other_ids_do_not_stop_a_day(spark, staged, folder, monkeypatch):
    real = daily._ids_of
    monkeypatch.setattr(daily, "_ids_of", lambda s: real(s).withColumn("id_hash", F.lit(7).cast("bigint")))
    rows = [("u", "login", f"2024-01-0{d} 08:00:00") for d in (1, 2)]
    lake, path = folder("lake"), folder("by-day")
    write_parquet_lake(staged(rows), lake)
    for day in (1, 2):
        assert daily.run_daily(spark, lake, path, f"2024-01-0{day}") == "loaded"


@pytest.mark.parametrize("table", ["fact_orders", "activity_words"])
def test_a_failure_between_two_tables_changes_nothing(spark, warehouse, monkeypatch, table):
    _, lake, path = warehouse
    daily.run_daily(spark, lake, path, "2024-01-01")
    before, state = _state(spark, path), read_state(spark, path)
    real = Publication.write

    def fails(self, df, name, *args, **more):
        if name == table:
            raise RuntimeError("no space left")
        return real(self, df, name, *args, **more)

    monkeypatch.setattr(Publication, "write", fails)
    for load in (
        lambda: daily.run_daily(spark, lake, path, "2024-01-02"),
        lambda: daily.run_daily(spark, lake, path, "2024-01-01"),
        lambda: daily.rebuild(spark, lake, path),
    ):
        with pytest.raises(RuntimeError, match="no space"):
            load()
        assert _state(spark, path) == before and read_state(spark, path) == state
    # Nor does anything of them stay behind.
    assert {n for n in file_names(spark, f"{path}/fact_events") if n.startswith("run=")} == {
        f"run={r}" for r in state.tables["fact_events"].values()
    }
    monkeypatch.setattr(Publication, "write", real)
    assert daily.run_daily(spark, lake, path, "2024-01-02") == "loaded"
    assert len(_state(spark, path)["events"]) > len(before["events"])


def test_words_of_days_equal_the_marts_of_events(spark, staged, folder):
    """Days one by one, some loaded twice with other rows in between, against all facts."""
    rng = random.Random(5)
    start = datetime.date(2024, 2, 10)
    days = [start + datetime.timedelta(days=d) for d in (0, 1, 2, 18, 19, 49)]
    rows = [
        (f"u{rng.randrange(40)}", "login", f"{day} 0{h}:00:00") for day in days for h in range(1, 9) for _ in range(4)
    ]
    lake, path = folder("lake"), folder("by-day")
    write_parquet_lake(staged(rows), lake)
    for day in days:
        if day == days[3]:
            whole = spark.read.parquet(f"{lake}/date={day}").collect()
            kept = spark.createDataFrame(whole, spark.read.parquet(f"{lake}/date={day}").schema)
            kept.limit(3).withColumn("user_id", F.lit("only then")).coalesce(1).write.mode("overwrite").parquet(
                f"{lake}/date={day}"
            )
            daily.run_daily(spark, lake, path, day)
            kept.coalesce(1).write.mode("overwrite").parquet(f"{lake}/date={day}")
        daily.run_daily(spark, lake, path, day)
    facts, words = daily.read_fact_events(spark, path), daily.read_activity_words(spark, path)
    for as_of in (days[-1], days[3], days[1]):
        got, want = marts.dau_mau_of_words(words, as_of), marts.dau_mau(facts, as_of)
        assert got.collect() == want.collect()
    late = days[-1] + datetime.timedelta(days=40)
    assert marts.retention_of_words(words, late).collect() == marts.retention(facts, late).collect()
    plan = marts.dau_mau_of_words(words, days[-1])._jdf.queryExecution().executedPlan().toString()
    assert "fact_events" not in plan
    whole = folder("whole")
    daily.rebuild(spark, lake, whole)
    rebuilt = daily.read_activity_words(spark, whole)
    assert rebuilt.exceptAll(words).isEmpty() and rebuilt.count() == words.count()


def test_rejected_rows_are_kept_with_reason_and_file(spark, staged, folder):
    rows = [(f"u{i}", "login", "2024-01-01 08:00:00") for i in range(5)]
    lake, path = folder("lake"), folder("warehouse")
    write_json_lake(staged(rows), lake)
    broken = ['{"event_id": "x", "user_id": ', '{"event_id":"y","user_id":"u9","event_date":"2024-01-01","amount":"many"}']
    spark.createDataFrame([(line,) for line in broken], "value string").coalesce(1).write.mode("append").text(
        f"{lake}/date=2024-01-01"
    )
    with pytest.raises(DataQualityError, match="corrupt_line=2"):
        daily.run_daily(spark, lake, path, "2024-01-01", fmt="json")
    assert daily.read_fact_events(spark, path).count() == 0
    kept = daily.read_rejected(spark, path).collect()
    assert {r.record for r in kept} == set(broken)
    assert all("corrupt_line" in r.reasons and r.file.endswith(".txt") for r in kept)
    assert daily.run_daily(spark, lake, path, "2024-01-01", fmt="json", set_aside=True) == "loaded"
    assert daily.read_fact_events(spark, path).count() == 5
    assert {r.record for r in daily.read_rejected(spark, path).collect()} == set(broken)
    # Once the lines are mended, nothing is rejected any more.
    for name in file_names(spark, f"{lake}/date=2024-01-01"):
        delete_path(spark, f"{lake}/date=2024-01-01/{name}")
    write_json_lake(staged(rows), lake)
    assert daily.run_daily(spark, lake, path, "2024-01-01", fmt="json") == "loaded"
    assert daily.read_rejected(spark, path).count() == 0


def test_copies_of_the_open_versions_change_nothing(spark, staged, folder, monkeypatch):
    monkeypatch.setattr(daily, "SNAPSHOT_EVERY", 2)
    rows = []
    for day in range(1, 8):
        platform = "ios" if day % 2 else "web"
        rows.append(("u", "login", f"2024-01-0{day} 08:00:00", {"platform": platform}))
        rows.append((f"new{day}", "signup", f"2024-01-0{day} 09:00:00"))
    lake, by_day, whole = folder("lake"), folder("by-day"), folder("whole")
    write_parquet_lake(staged(rows), lake)
    for day in range(1, 8):
        daily.run_daily(spark, lake, by_day, f"2024-01-0{day}")
    copies = read_state(spark, by_day).partitions("dim_user_open")
    assert copies == ["2024-01-02", "2024-01-04", "2024-01-06"]
    daily.run_daily(spark, lake, by_day, "2024-01-07")
    daily.rebuild(spark, lake, whole)
    assert _state(spark, by_day) == _state(spark, whole)


def test_an_emptied_day_and_a_missing_one(spark, warehouse, folder):
    _, lake, path = warehouse
    for day in (1, 2, 3):
        daily.run_daily(spark, lake, path, f"2024-01-0{day}")
    none = spark.read.parquet(f"{lake}/date=2024-01-03").where(F.lit(False))
    none.coalesce(1).write.mode("overwrite").parquet(f"{lake}/date=2024-01-03")
    assert daily.run_daily(spark, lake, path, "2024-01-03") == "loaded"
    early = folder("early")
    for day in (1, 2):
        daily.run_daily(spark, lake, early, f"2024-01-0{day}")
    assert _state(spark, path) == _state(spark, early)
    assert daily.run_daily(spark, lake, path, "2024-01-04") == "missing"


@pytest.mark.parametrize(
    ("column", "value", "reason"),
    [
        ("event_date", "2024-99-99", "event_date=1"),
        ("event_date", "2024-01-02", "event_date_unlike_folder=1"),
        ("event_timestamp", "noon", "event_timestamp=1"),
        ("event_timestamp", "2024-01-05T08:00:00Z", "time_outside_day=1"),
        ("amount", 250_000_000.0, "amount=1"),
        ("event_type", None, "event_type=1"),
        ("event_id", None, "missing_required=1"),
    ],
)
def test_a_row_that_staging_cannot_hold_stops_the_load(spark, warehouse, column, value, reason):
    _, lake, path = warehouse
    day = spark.read.parquet(f"{lake}/date=2024-01-01").limit(1)
    bad = day.withColumn("event_id", F.lit("one more")).withColumn(
        column, F.lit(value).cast(day.schema[column].dataType)
    )
    bad.write.mode("append").parquet(f"{lake}/date=2024-01-01")
    with pytest.raises(DataQualityError, match=reason):
        daily.run_daily(spark, lake, path, "2024-01-01")
    with pytest.raises(DataQualityError, match=reason):
        daily.rebuild(spark, lake, path)
    assert daily.read_fact_events(spark, path).count() == 0


def test_loads_leave_no_scratch_tables(spark, warehouse):
    from tidemark.sources import scratch

    _, lake, path = warehouse
    app = spark.sparkContext.applicationId
    before = list(scratch._made[app])
    daily.run_daily(spark, lake, path, "2024-01-01")
    daily.rebuild(spark, lake, path)
    assert scratch._made[app] == before

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF
from tidemark.operators.scd2 import interval_problems, new_keys, pit_join, scd2_history, scd2_merge
from tidemark.schemas import OPEN_END
from workload.fixtures import events


def _versions(df):
    cols = ["user_id", "country", "preferred_platform", "valid_from", "valid_to", "is_current"]
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def _at(text):
    return datetime.datetime.fromisoformat(text)


def test_flip_flop_keeps_every_version(staged):
    rows = staged(
        [
            ("u", "login", f"2024-01-0{day} 10:00:00", {"platform": platform})
            for day, platform in enumerate(["ios", "web", "ios", "ios"], start=1)
        ]
    )
    got = _versions(scd2_history(rows))
    assert sorted((v[3].day, v[2], v[4] == OPEN_END, v[5]) for v in got) == [
        (1, "ios", False, False),
        (2, "web", False, False),
        (3, "ios", True, True),
    ]


def test_only_the_latest_row_of_a_batch_counts(staged):
    rows = staged(
        [
            ("u", "login", "2024-01-01 08:00:00", {"platform": "ios"}),
            ("u", "login", "2024-01-01 09:00:00", {"platform": "web"}),
            ("u", "login", "2024-01-01 20:00:00", {"platform": "ios"}),
        ]
    )
    (only,) = _versions(scd2_history(rows))
    assert only[2:4] == ("ios", _at("2024-01-01 20:00:00"))
    (first,) = _versions(scd2_history(rows, new_key_start="first"))
    assert first[3] == _at("2024-01-01 08:00:00")


def test_equal_times_fall_to_the_higher_event_id(staged):
    at = "2024-01-01 08:00:00"
    rows = staged(
        [
            ("u", "login", at, {"platform": "ios", "event_id": "a"}),
            ("u", "login", at, {"platform": "web", "event_id": "b"}),
        ]
    )
    assert _versions(scd2_history(rows))[0][2] == "web"


def test_unknown_attributes_never_open_a_version(staged):
    rows = staged(
        [
            ("u", "login", "2024-01-01 08:00:00", {"country": "US"}),
            ("u", "login", "2024-01-02 08:00:00", {"country": None}),
            ("u", "login", "2024-01-03 08:00:00", {"country": "US"}),
            ("v", "login", "2024-01-03 08:00:00", {"country": None}),
        ]
    )
    got = _versions(scd2_history(rows))
    assert [(v[0], v[3].day) for v in got] == [("u", 1)]


def test_daily_merges_equal_the_closed_form(spark):
    rows = events(spark, SF)
    days = [r.event_date for r in rows.select("event_date").distinct().orderBy("event_date").collect()]
    dim = scd2_history(rows.where(F.col("event_date") <= F.lit(days[9])))
    for day in days[10:14]:
        dim = scd2_merge(dim, rows.where(F.col("event_date") == F.lit(day)))
    want = scd2_history(rows.where(F.col("event_date") <= F.lit(days[13])))
    columns = ["user_sk", "user_id", "country", "preferred_platform", "valid_from", "valid_to"]
    assert sorted(map(tuple, dim.select(*columns).collect())) == sorted(
        map(tuple, want.select(*columns).collect())
    )


def test_first_merge_into_nothing_and_a_batch_without_changes(staged):
    rows = staged([("u", "login", "2024-01-01 08:00:00"), ("v", "login", "2024-01-01 09:00:00")])
    empty = scd2_history(rows).where(F.lit(False))
    dim = scd2_merge(empty, rows)
    assert sorted(r.user_sk for r in dim.collect()) == [1, 2]
    later = staged([("u", "login", "2024-01-02 08:00:00")])
    assert _versions(scd2_merge(dim, later)) == _versions(dim)


def test_late_batch_is_refused_or_rebuilt(staged):
    first = staged([("u", "login", "2024-01-03 08:00:00", {"platform": "ios"})])
    late = staged([("u", "login", "2024-01-01 08:00:00", {"platform": "web"})])
    dim = scd2_history(first)
    with pytest.raises(ValueError, match="older"):
        scd2_merge(dim, late)
    whole = first.unionByName(late)
    rebuilt = scd2_merge(dim, late, rebuild=whole)
    assert _versions(rebuilt) == _versions(scd2_history(whole))
    assert all(r.passed for r in interval_problems(rebuilt).collect())


def test_interval_problems_are_counted(spark):
    rows = [
        ("a", "2024-01-01", "2024-01-05", False),
        ("a", "2024-01-04", "9999-12-31", True),
        ("b", "2024-01-02", "2024-01-02", False),
        ("c", "2024-01-01", "9999-12-31", True),
    ]
    dim = spark.createDataFrame(rows, "user_id string, a string, b string, is_current boolean")
    dim = dim.select(
        "user_id",
        F.col("a").cast("timestamp_ntz").alias("valid_from"),
        F.col("b").cast("timestamp_ntz").alias("valid_to"),
        "is_current",
    )
    got = {r.check: r.failing_rows for r in interval_problems(dim).collect()}
    assert got == {"empty_interval": 1, "overlap": 1, "not_one_current": 1}


@pytest.mark.parametrize("hot", [{}, {"u": 16}])
def test_point_in_time_bounds(staged, hot):
    rows = staged(
        [
            ("u", "login", "2024-01-01 08:00:00", {"platform": "ios"}),
            ("u", "login", "2024-01-02 08:00:00", {"platform": "web"}),
        ]
    )
    facts = staged(
        [
            ("u", "like", "2024-01-01 07:59:59", {"event_id": "before"}),
            ("u", "like", "2024-01-01 08:00:00", {"event_id": "at start"}),
            ("u", "like", "2024-01-02 07:59:59", {"event_id": "last of first"}),
            ("u", "like", "2024-01-02 08:00:00", {"event_id": "at change"}),
            ("x", "like", "2024-01-02 08:00:00", {"event_id": "unknown user"}),
        ]
    )
    dim = scd2_history(rows)
    got = pit_join(facts, dim, take=["preferred_platform"], hot=hot)
    assert {(r.event_id, r.preferred_platform) for r in got.collect()} == {
        ("at start", "ios"),
        ("last of first", "ios"),
        ("at change", "web"),
    }
    kept = pit_join(facts, dim, take=["preferred_platform"], how="left", hot=hot)
    assert kept.count() == 5


def test_new_keys(staged):
    dim = scd2_history(staged([("u", "login", "2024-01-01 08:00:00")]))
    batch = staged([("u", "login", "2024-01-02 08:00:00"), ("v", "login", "2024-01-02 09:00:00")])
    assert [r.user_id for r in new_keys(dim.where("is_current"), batch).collect()] == ["v"]


def test_a_change_before_the_open_version_of_the_same_day_is_refused(staged):
    noon = staged([("u", "login", "2024-01-03 12:00:00", {"platform": "ios"})])
    earlier = staged([("u", "login", "2024-01-03 10:00:00", {"platform": "web"})])
    dim = scd2_history(noon)
    with pytest.raises(ValueError, match="older"):
        scd2_merge(dim, earlier).count()

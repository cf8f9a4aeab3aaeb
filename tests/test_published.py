"""Tables that change together, or not at all."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.published import ConcurrentLoad, Publication, read_state, read_table
from tidemark.sources.sinks import file_names

SCHEMA = T.StructType([T.StructField("v", T.LongType())])
DAY = T.StructField("day", T.DateType())


def rows(spark, *pairs):
    df = spark.createDataFrame(pairs, "v long, day string")
    return df.select("v", F.col("day").cast("date").alias("day"))


def held(spark, root, table="t", state=None):
    return sorted((r.v, str(r.day)) for r in read_table(spark, root, table, SCHEMA, DAY, state).collect())


def load(spark, root, changes, only=None):
    with Publication(spark, root) as out:
        for table, df in changes.items():
            out.write(df, table, "day", "v", only)
        out.publish()


def test_tables_change_together(spark, folder):
    root = folder("w")
    assert held(spark, root) == [] and read_state(spark, root).number == 0
    load(spark, root, {"t": rows(spark, (1, "2024-01-01"), (2, "2024-01-02")), "u": rows(spark, (5, "2024-01-01"))})
    with Publication(spark, root) as out:
        out.write(rows(spark, (3, "2024-01-02")), "t", "day", "v", ["2024-01-02"])
        out.drop("u")
        # Seen by who holds the publication, by nobody else.
        assert held(spark, root, state=out.state) == [(1, "2024-01-01"), (3, "2024-01-02")]
        assert held(spark, root) == [(1, "2024-01-01"), (2, "2024-01-02")] and held(spark, root, "u")
        out.publish()
    assert held(spark, root) == [(1, "2024-01-01"), (3, "2024-01-02")] and held(spark, root, "u") == []


def test_readers_of_the_state_before_are_not_disturbed(spark, folder):
    root = folder("w")
    load(spark, root, {"t": rows(spark, (1, "2024-01-01"))})
    state = read_state(spark, root)
    before = read_table(spark, root, "t", SCHEMA, DAY, state)
    load(spark, root, {"t": rows(spark, (2, "2024-01-01"))}, ["2024-01-01"])
    assert [r.v for r in before.collect()] == [1]
    # What was replaced two states ago is gone, and old state files with it.
    load(spark, root, {"t": rows(spark, (3, "2024-01-01"))}, ["2024-01-01"])
    folders = [n for n in file_names(spark, f"{root}/t") if file_names(spark, f"{root}/t/{n}") - {"_SUCCESS", "._SUCCESS.crc"}]
    assert len(folders) == 2
    states = [n for n in file_names(spark, f"{root}/_states") if n.endswith(".json")]
    assert sorted(states) == ["00000002.json", "00000003.json"]


def test_a_partition_without_rows_is_empty_and_others_stay(spark, folder):
    root = folder("w")
    load(spark, root, {"t": rows(spark, (1, "2024-01-01"), (2, "2024-01-02"))})
    load(spark, root, {"t": rows(spark, (1, "2024-01-01")).where("false")}, ["2024-01-02", "2024-01-09"])
    assert held(spark, root) == [(1, "2024-01-01")]
    load(spark, root, {"t": rows(spark, (7, "2024-01-05"))})
    assert held(spark, root) == [(7, "2024-01-05")]


def test_rows_of_other_partitions_are_refused(spark, folder):
    root = folder("w")
    with pytest.raises(ValueError, match="2024-01-02"):
        load(spark, root, {"t": rows(spark, (1, "2024-01-01"), (2, "2024-01-02"))}, ["2024-01-01"])
    assert held(spark, root) == [] and file_names(spark, f"{root}/t") == set()


def test_the_second_of_two_loads_at_once_is_refused(spark, folder):
    root = folder("w")
    with Publication(spark, root) as one, Publication(spark, root) as two:
        one.write(rows(spark, (1, "2024-01-01")), "t", "day", "v")
        two.write(rows(spark, (2, "2024-01-01")), "t", "day", "v")
        one.publish()
        with pytest.raises(ConcurrentLoad):
            two.publish()
    assert held(spark, root) == [(1, "2024-01-01")]


def test_leaving_without_publishing_leaves_nothing(spark, folder):
    root = folder("w")
    with Publication(spark, root) as out:
        out.write(rows(spark, (1, "2024-01-01")), "t", "day", "v")
    assert held(spark, root) == [] and file_names(spark, f"{root}/t") == set()

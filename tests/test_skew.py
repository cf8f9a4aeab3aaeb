"""Hot keys: same results as the plain operators, and plans that spread them."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import skew
from tidemark.operators.keys import LANES, dense_keys, lane_keys, ntile_of, rank_descending
from tidemark.operators.skew import hot_keys, skewed_join


@pytest.fixture
def uneven(spark):
    """A third of the rows on one key, some without a key."""
    return spark.range(30_000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 100 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("u"), (F.col("id") % 997).cast("string")))
        .alias("user_id"),
    )


@pytest.fixture
def dim(spark):
    names = spark.range(900).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"))
    hot = spark.createDataFrame([("hot",), ("unused",)], "user_id string")
    return names.union(hot).withColumn("sk", F.abs(F.xxhash64("user_id")))


def test_hot_keys_are_found(monkeypatch, uneven):
    big = uneven.union(uneven)
    assert hot_keys(big, "user_id", share=0.01) == {"hot": 4}
    monkeypatch.setattr(skew, "WORTH_SPLITTING", 100)
    assert hot_keys(big, "user_id", share=0.01) == {"hot": 128}
    monkeypatch.setattr(skew, "WORTH_SPLITTING", 1_000_000)
    assert hot_keys(big, "user_id", share=0.01) == {}


def test_keys_are_found_in_sparse_partitions(spark, monkeypatch, uneven):
    monkeypatch.setattr(skew, "WORTH_SPLITTING", 100)
    few = uneven.where("user_id = 'hot'").coalesce(1)
    assert set(hot_keys(few.union(uneven.where("event_id = 1")), "user_id")) == {"hot"}
    assert hot_keys(uneven.where("event_id < 0"), "user_id") == {}


def test_searched_join_equals_the_plain_join(monkeypatch, uneven, dim):
    monkeypatch.setattr(skew, "WORTH_SPLITTING", 100)
    got = skewed_join(uneven, dim, "user_id", spread_by=["event_id"])
    want = uneven.join(dim, "user_id").select(*got.columns)
    assert "__piece" in got._jdf.queryExecution().toString()
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [{}, {"hot": 64}, {"hot": 64, "u1": 2, "not there": 8}])
def test_join_equals_the_plain_join(spark, uneven, dim, how, hot):
    got = skewed_join(uneven, dim, "user_id", how=how, spread_by=["event_id"], hot=hot)
    want = uneven.join(dim, "user_id", how).select("event_id", "user_id", "sk")
    got = got.select("event_id", "user_id", "sk")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_right_join_keeps_every_key(uneven, dim):
    got = (
        skewed_join(uneven, dim, "user_id", how="right", spread_by=["event_id"], hot={"hot": 64})
        .groupBy("user_id", "sk")
        .agg(F.min("event_id").alias("first"))
    )
    want = (
        uneven.join(dim, "user_id", "right").groupBy("user_id", "sk").agg(F.min("event_id"))
    )
    assert got.count() == dim.count()
    assert got.exceptAll(want).count() == 0


def test_hot_rows_are_spread(spark, uneven, dim):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        for hot, fair in (({"hot": 64}, True), ({}, False)):
            joined = skewed_join(uneven, dim, "user_id", spread_by=["event_id"], hot=hot)
            sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
            largest = max(r["count"] for r in sizes) / sum(r["count"] for r in sizes)
            assert (largest < 0.3) == fair
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_dense_keys_equal_a_global_row_number(spark):
    # Half the rows share one leading value.
    rows = spark.range(5_000).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("at")
    )
    got = dense_keys(rows.repartition(13), ["at", "id"], "sk", start=100)
    want = rows.withColumn("sk", F.row_number().over(W.orderBy("at", "id")) + 100)
    assert got.count() == 5_000
    assert got.exceptAll(want.select("id", "at", F.col("sk").cast("bigint"))).count() == 0


def test_dense_keys_of_nothing(spark):
    assert dense_keys(spark.range(0), ["id"], "sk").count() == 0


def test_lane_keys_are_unique_and_repeatable(spark):
    rows = spark.range(20_000).select("id", (F.col("id") % 2).alias("day"))
    one = lane_keys(rows, "day", "id", ["id"], "sk")
    two = lane_keys(rows.repartition(7, "id"), "day", "id", ["id"], "sk")
    assert one.exceptAll(two).count() == 0
    assert one.select("day", "sk").distinct().count() == 20_000
    top = one.agg(F.max("sk")).first()[0]
    assert top < 20 * LANES


@pytest.mark.parametrize("n", [1, 2, 9, 10, 11, 37])
def test_ranks_equal_the_window_functions(spark, n):
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("user_id"), (F.col("id") % 4).alias("events")
    )
    got = rank_descending(rows, "events", "user_id", 10, "pr", "tile")
    by_events = W.orderBy(F.col("events").desc())
    want = rows.select(
        "user_id",
        "events",
        F.percent_rank().over(by_events).alias("pr"),
        F.ntile(10).over(W.orderBy(F.col("events").desc(), "user_id")).cast("bigint").alias("tile"),
    )
    assert got.exceptAll(want).count() == 0
    assert got.count() == n


def test_ntile_matches_for_many_sizes(spark):
    rows = spark.range(1, 41).select(F.explode(F.sequence(F.lit(1), "id")).alias("r"), F.col("id").alias("n"))
    got = rows.select("n", "r", ntile_of(F.col("r"), F.col("n"), 7).alias("t"))
    want = rows.select(
        "n", "r", F.ntile(7).over(W.partitionBy("n").orderBy("r")).cast("bigint").alias("t")
    )
    assert got.exceptAll(want).count() == 0

"""The as-of join against the plain range join, and what it costs on uneven keys."""

import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import skew
from tidemark.operators.asof import asof_join, time_cuts

EPOCH = "2024-01-01"


def _at(seconds):
    return F.timestamp_add("SECOND", seconds, F.lit(EPOCH).cast("timestamp_ntz"))


@pytest.fixture
def facts(spark):
    """A third of the rows on one key, a tenth of those at one instant; some keys and times NULL."""
    n = F.col("id")
    hot = n % 3 == 0
    second = F.when(hot & (n % 10 == 0), F.lit(5000)).otherwise(F.pmod(n * 7919, F.lit(20_000))).cast("int")
    return spark.range(12_000).select(
        F.col("id").alias("event_id"),
        F.when(hot, F.lit("hot")).when(n % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("u"), n % 91)).alias("user_id"),
        F.when(n % 77 == 5, F.lit(None)).otherwise(_at(second)).alias("at"),
        (n % 7).alias("user_tier"),
    )


@pytest.fixture
def versions(spark):
    """Per key some versions, with gaps, touching ones, an empty one and an open end."""
    n = F.col("id")
    key = F.when(n % 20 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), n % 80))
    place = (n / 20).cast("int")
    begin = F.when(key == "hot", place * 400).otherwise((n / 80).cast("int") * 3000)
    length = F.when(n % 6 == 0, F.lit(100)).when(n % 6 == 1, F.lit(0)).otherwise(F.lit(400))
    end = F.when((key != "hot") & (n >= 320), F.lit(10**6)).otherwise(begin + length)
    rows = spark.range(400).select(
        key.alias("user_id"), n.alias("user_sk"), _at(begin.cast("int")).alias("valid_from"), _at(end.cast("int")).alias("valid_to")
    )
    return rows.union(rows.limit(1).withColumn("user_id", F.lit(None).cast("string")))


def plain(facts, versions, how):
    v = versions.withColumnRenamed("user_id", "vid")
    on = (F.col("user_id") == F.col("vid")) & (F.col("at") >= F.col("valid_from")) & (F.col("at") < F.col("valid_to"))
    return facts.join(v, on, how).select(*facts.columns, "user_sk")


def joined(facts, versions, how="inner", hot=None):
    return asof_join(facts, versions, "user_id", "at", "valid_from", "valid_to", ["user_sk"], how, ["event_id"], hot)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [{}, {"hot": 64, "u7": 2, "nobody": 8}, {"hot": 2048}])
def test_equals_the_range_join(facts, versions, how, hot):
    got, want = joined(facts, versions, how, hot), plain(facts, versions, how)
    assert got.columns == want.columns
    assert got.count() == want.count() > 1000
    assert got.exceptAll(want).isEmpty()


def test_finds_hot_keys_itself(facts, versions, monkeypatch):
    monkeypatch.setattr(skew, "WORTH_SPLITTING", 100)
    got = joined(facts, versions)
    assert "__cut_key" in got._jdf.queryExecution().toString()
    assert got.exceptAll(plain(facts, versions, "inner")).isEmpty()


def test_pieces_of_a_hot_key_are_even(facts):
    hot = {"hot": 16}
    cuts = time_cuts(facts, "user_id", "at", hot)
    assert list(cuts) == ["hot"] and len(cuts["hot"]) == 15 and cuts["hot"] == sorted(cuts["hot"])
    assert time_cuts(facts, "user_id", "at", {}) == {}
    rows = sorted(r[0].timestamp() for r in facts.where("user_id = 'hot' AND at IS NOT NULL").select("at").collect())
    # The instant that holds a tenth of the rows is cut more than once.
    assert len(set(cuts["hot"])) < 15 < len(rows)


def test_empty_sides(spark, facts, versions):
    none = versions.where("false")
    assert joined(facts, none).isEmpty()
    assert joined(facts, none, "left").count() == facts.count()
    assert joined(facts.where("false"), versions, "left").isEmpty()
    with pytest.raises(ValueError, match="join type"):
        joined(facts, versions, "right")


def test_a_key_costs_its_facts_plus_its_versions(spark):
    """One key with 100,000 facts and 10,000 versions: a thousand million pairs by the range join."""
    n = F.col("id")
    facts = spark.range(100_000).select(F.lit("k").alias("user_id"), n.alias("event_id"), _at((n * 37 % 100_000).cast("int")).alias("at"))
    versions = spark.range(10_000).select(
        F.lit("k").alias("user_id"), n.alias("user_sk"), _at((n * 10).cast("int")).alias("valid_from"), _at((n * 10 + 10).cast("int")).alias("valid_to")
    )
    begin = time.perf_counter()
    got = joined(facts, versions, hot={})
    wrong = F.timestamp_diff("SECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col("at")).cast("int") / 10
    row = got.agg(F.count("*").alias("n"), F.count_if(F.col("user_sk") != F.floor(wrong)).alias("wrong")).first()
    assert (row.n, row.wrong) == (100_000, 0)
    assert time.perf_counter() - begin < 20


def test_one_shuffle_and_no_join(facts, versions):
    plan = joined(facts, versions, hot={})._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1


def test_the_key_is_shuffled_once(facts, versions):
    joined = asof_join(facts, versions, "user_id", "at", "valid_from", "valid_to", ["user_sk"], hot={})
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    union = plan[plan.index("Union") :].splitlines()[1]
    assert union.count("user_id") == 1

"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import pin


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest one."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    root = F.least("a", "least")
    return (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(root.alias("a"), "b")
        .where(F.col("a") != F.col("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("least"))
    joined = links.join(least, "b")
    moved = joined.select(F.col("least").alias("a"), F.col("a").alias("b"))
    own = least.select(F.col("least").alias("a"), "b")
    return moved.unionByName(own).where(F.col("a") != F.col("b")).distinct()


def _state(links: DataFrame) -> tuple:
    """Count and order-free sums by which two link tables are told apart."""
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        F.sum(F.hash("b", "a").cast("bigint")).alias("t"),
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)``; ``root`` is its component's least node.

    Each round halves distances at least; its links are written to the shared folder, so
    no round's loss costs the rounds before it. The least neighbour comes from an
    aggregate with map-side reduction and meets its links in a join that Spark splits
    where one node has very many. Loops and repeated links do no harm.
    """
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    current = pin(pairs.where(F.col("a") != F.col("b")).distinct(), "links")
    state = _state(current)
    while state[0]:
        current = pin(_small_star(_large_star(current)), "links")
        following = _state(current)
        if following == state:
            break
        state = following
    roots = current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return current.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)

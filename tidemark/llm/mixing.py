"""Mixing sources: budgets down a domain-language-source tree, then a prefix of each leaf.

A node's budget goes to its children by their weights. A child that holds less than its
share gives the rest to its siblings, so a shortage stays as deep in the tree as it can:
it reaches another language only when all sources of the language are used up, and
another domain only when all its languages are. Each leaf then reads its documents in
the seeded order of epoch 0, then of epoch 1, and so on, up to its budget.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import words_of
from tidemark.sources.scratch import pin

LEVELS = ("domain", "lang", "source")
EPOCHS = 2
SHARE = 0.6  # of all tokens that are there
SEED = 17
LANE_DIGITS = 3  # of a digest: 4096 slices of a leaf's order, of which one is ever sorted
OTHER = "other"

# Weights of the production mix, whole numbers. Sources weigh the same unless named.
DOMAIN_WEIGHTS = {"web": 40, "books": 30, "forums": 20, "reference": 10}
LANG_WEIGHTS = {"en": 50, "de": 20, "fr": 20, "es": 10}
REST = 5
DOMAINS = ("web", "books", "forums", "reference")
SOURCES_PER_DOMAIN = 5


def domain_of(source: Column) -> Column:
    """Five sources to a domain by their number; others and NULL are ``other``."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"^src([0-9]{1,9})$", 1).try_cast("int")
    place = F.floor(number / F.lit(SOURCES_PER_DOMAIN)).cast("int")
    return F.coalesce(F.get(F.array(*map(F.lit, DOMAINS)), place), F.lit(OTHER))


def _weight(name: Column, weights: Mapping[str, int], rest: int) -> Column:
    chosen = F.lit(rest)
    for key, weight in weights.items():
        chosen = F.when(name == F.lit(key), F.lit(weight)).otherwise(chosen)
    return chosen.cast("bigint")


def leaf_weights(
    leaves: DataFrame,
    domain: Mapping[str, int] = DOMAIN_WEIGHTS,
    lang: Mapping[str, int] = LANG_WEIGHTS,
    source: Mapping[str, int] | None = None,
    rest: int = REST,
) -> DataFrame:
    """Add ``weight_domain``, ``weight_lang`` and ``weight_source``; unnamed ones weigh ``rest``."""
    return leaves.withColumns(
        {
            "weight_domain": _weight(F.col("domain"), domain, rest),
            "weight_lang": _weight(F.col("lang"), lang, rest),
            "weight_source": _weight(F.col("source"), source or {}, 1),
        }
    )


def _fill(children: DataFrame, parent: Sequence[str], name: str, weight: str) -> DataFrame:
    """Share ``budget`` of each parent among its children by weight, none above its ``capacity``.

    The children that the budget fills up are those with the least capacity per weight.
    With them in that order, the level is what is left for the others over their weight;
    it rises until the next child is no longer filled up. What children cannot take is
    left over only when all are full.
    """
    ratio = F.col("capacity") / F.col(weight)
    ordered = W.partitionBy(*parent).orderBy(ratio, name)
    before = ordered.rowsBetween(W.unboundedPreceding, -1)
    onward = ordered.rowsBetween(W.currentRow, W.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    level = left.cast("double") / F.sum(weight).over(onward)
    full = children.withColumn("level", level).withColumn("full", ratio <= F.col("level"))
    # The first child that is not filled up sets the level of all that follow.
    entry = F.struct(ratio.alias("r"), F.col(name).alias("n"), F.col("level").alias("l"))
    common = F.min(F.when(~F.col("full"), entry)).over(W.partitionBy(*parent))
    share = F.when(F.col("full"), F.col("capacity")).otherwise(
        F.least(F.col("capacity"), F.floor(common["l"] * F.col(weight)).cast("bigint"))
    )
    return full.withColumn("budget", share).drop("level", "full")


def budgets(
    leaves: DataFrame, total: Column, epochs: int = EPOCHS, levels: Sequence[str] = LEVELS
) -> DataFrame:
    """``budget`` of every leaf, in tokens.

    ``leaves`` has one row per leaf with the ``levels``, ``tokens`` and a ``weight_`` per
    level; ``total`` is how many tokens to hand out. A leaf can give its tokens ``epochs``
    times. Budgets are whole tokens, rounded down at each level. Children without a
    positive weight get nothing.
    """
    table = leaves.withColumns(
        {"capacity": F.col("tokens") * F.lit(epochs), "root": F.lit(0), "total": total}
    )
    path: list[str] = ["root"]
    shared: DataFrame | None = None
    for level in levels:
        weight = f"weight_{level}"
        node = [*path, level]
        children = (
            table.where(F.col(weight) > 0)
            .groupBy(*node)
            .agg(
                F.sum("capacity").alias("capacity"),
                F.max(weight).alias(weight),
                F.max("total").alias("total"),
            )
        )
        if shared is None:
            held = F.sum("capacity").over(W.partitionBy("root"))
            children = children.withColumn("budget", F.least("total", held))
        else:
            children = children.join(shared, path)
        filled = _fill(children, path, level, weight)
        shared = filled.select(*node, "budget")
        path = node
    return shared.drop("root")


def seeded_order(seed: int, epoch: Column, key: Column) -> Column:
    """Where a document comes in an epoch: a digest, so that any engine can follow it."""
    parts = [F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit(""))]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def mix(
    docs: DataFrame,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
    weigh=leaf_weights,
) -> DataFrame:
    """The chosen rows of ``docs (domain, lang, source, tokens, key, tie, …)`` with ``epoch``, ``taken``.

    A leaf takes the documents of epoch 0 in seeded order, then those of epoch 1, until its
    budget is spent to the token: of the document in which it ends, ``taken`` tells how many
    tokens still belong to the prefix, of those before it that is ``tokens``. The order is a
    digest of ``key``, or of ``tie`` where that is NULL, cut into slices by its
    first digits: sums per slice tell in which slice the budget ends, slices before it are
    taken whole, and that one slice alone is sorted. Thus a leaf that holds most documents
    is never in one task.

    Rows of one key are ordered by ``tie``. NULL languages and sources share a leaf with
    empty ones. A document without tokens comes if its place lies within the prefix.
    """
    names = list(LEVELS)
    leaf = [F.coalesce(F.col(n), F.lit("")).alias(f"leaf_{n}") for n in names]
    keys = [f"leaf_{n}" for n in names]
    passes = docs.select(
        *docs.columns, *leaf, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")
    )
    key = F.coalesce(F.col("key").cast("string"), F.col("tie"))
    ordered = passes.withColumn("order", seeded_order(seed, F.col("epoch"), key))
    ordered = ordered.withColumn("lane", F.substring("order", 1, LANE_DIGITS))
    slices = ordered.groupBy(*keys, "epoch", "lane").agg(F.sum("tokens").alias("tokens"))
    slices = pin(slices, "slices")
    leaves = slices.where(F.col("epoch") == 0).groupBy(*keys).agg(F.sum("tokens").alias("tokens"))
    leaves = leaves.withColumnsRenamed(dict(zip(keys, names, strict=True)))
    # One row per leaf, so a window over all of them is small.
    everything = F.sum("tokens").over(W.partitionBy(F.lit(1)))
    leaves = leaves.withColumn("total", F.floor(everything * F.lit(float(share))).cast("bigint"))
    cut = budgets(weigh(leaves), F.col("total"), epochs)
    cut = cut.withColumnsRenamed(dict(zip(names, keys, strict=True)))
    # A leaf has at most 16 ** LANE_DIGITS slices per epoch.
    read = W.partitionBy(*keys).orderBy("epoch", "lane")
    before = F.sum("tokens").over(read.rowsBetween(W.unboundedPreceding, -1))
    reached = (
        slices.withColumn("before", F.coalesce(before, F.lit(0)))
        .join(cut, keys)
        .where(F.col("before") <= F.col("budget"))
        .groupBy(*keys, "budget")
        .agg(F.max(F.struct("epoch", "lane", "before")).alias("last"))
        .select(
            *keys,
            (F.col("budget") - F.col("last.before")).alias("left"),
            F.col("last.epoch").alias("last_epoch"),
            F.col("last.lane").alias("last_lane"),
        )
    )
    # One row per leaf, written out so that Spark knows its size when it picks the join.
    ends = pin(reached, "leaf-ends")
    met = ordered.join(ends, keys)
    same_epoch = F.col("epoch") == F.col("last_epoch")
    inside = met.where(
        (F.col("epoch") < F.col("last_epoch")) | (same_epoch & (F.col("lane") < F.col("last_lane")))
    )
    upto = W.partitionBy(*keys).orderBy("order", "tie").rowsBetween(W.unboundedPreceding, W.currentRow)
    edge = met.where(same_epoch & (F.col("lane") == F.col("last_lane")))
    room = F.col("left") - (F.col("sum") - F.col("tokens"))
    edge = edge.withColumn("sum", F.sum("tokens").over(upto)).withColumn("room", room)
    # A document without tokens may come last, right behind a prefix that is full.
    edge = edge.where((F.col("room") > 0) | (F.col("sum") <= F.col("left")))
    kept = [*docs.columns, "epoch"]
    whole = inside.select(*kept, F.col("tokens").alias("taken"))
    return whole.unionByName(edge.select(*kept, F.least("tokens", "room").alias("taken")))


def leaves_of(docs: DataFrame, *more: Column) -> DataFrame:
    """What ``mix`` reads of a documents table; a token is a word, NULL text has none."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        domain_of(F.col("source")).alias("domain"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.size(words_of(text)).cast("bigint").alias("tokens"),
        F.col("doc_id").alias("key"),
        F.md5(text.cast("binary")).alias("tie"),
        *more,
    )


def keep_mixed(docs: DataFrame, share: float, epochs: int, seed: int = SEED) -> DataFrame:
    """The chosen rows of ``docs`` with all their columns, once per epoch that takes them.

    The document in which a leaf's budget ends is kept whole.
    """
    rows = leaves_of(docs, F.struct(*docs.columns).alias("whole"))
    return mix(rows, share, epochs, seed).select("whole.*")

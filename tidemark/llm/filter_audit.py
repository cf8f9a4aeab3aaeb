"""How filters that are applied in a row overlap, for every order of applying them.

Each document is reduced to a mask of the filters it fails, and each part to at most 32
counted masks. What an order does to a mask needs no document: it is a fold along the order.
So one scan and two narrow shuffles answer for all 120 orders.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, words_of
from tidemark.sources.scratch import pin

LETTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(LETTERS))
LEAST_WORDS = 50
LEAST_DISTINCT = 65  # percent of the words
MOST_CAPITALS = 5  # percent of the characters
SYMBOLS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BIT = {letter: 1 << i for i, letter in enumerate(LETTERS)}
# Rows without an id meet no label; so many pieces keep them from sharing one task.
_SPREAD = 4096
_MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def own_mask(text: Column) -> Column:
    """Bits 1, 2, 4 and 8 for the filters A to D that ``text`` fails; NULL is an empty text."""
    whole = F.coalesce(text, F.lit(""))
    length = F.char_length(whole)
    capitals = length - F.char_length(F.translate(whole, CAPITALS, ""))

    def bits(words: Column) -> Column:
        n = F.size(words)
        return F.when(n < LEAST_WORDS, 1).otherwise(0) + F.when(
            F.size(F.array_distinct(words)) * 100 < n * LEAST_DISTINCT, 2
        ).otherwise(0)

    return (
        let(words_of(whole), bits)
        + F.when(capitals * 100 > length * MOST_CAPITALS, 4).otherwise(0)
        + F.when(whole.rlike(SYMBOLS), 8).otherwise(0)
    )


def _documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One narrow row per id, text, part and mask: ``n``, and how many are good and toxic."""
    numbered = F.monotonically_increasing_id() % _SPREAD
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).select(
        "doc_id",
        "part",
        own_mask(F.col("text")).alias("mask"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.when(F.col("doc_id").isNull(), numbered + 1).otherwise(0).alias("spread"),
    )
    known = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(
            F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
            F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
        )
        .withColumn("spread", F.lit(0).cast("bigint"))
    )
    return (
        narrow.withColumn("spread", F.col("spread").cast("bigint"))
        .join(known, ["doc_id", "spread"], "left")
        .groupBy("doc_id", "spread", "digest", "part", "mask")
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
        )
    )


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: the documents of each part by the filters they fail.

    Copies are counted per text and part before texts meet, so a text that a third of the
    rows share is one row per part there. Of such a group all documents fail E but those
    whose id is the least of the text in the whole table.
    """
    counts = ("n", "good", "toxic")
    nameless = F.col("doc_id").isNull()
    copies = (
        _documents(docs, labels)
        .groupBy("digest", "part", "mask", nameless.alias("nameless"))
        .agg(
            *[F.sum(c).alias(c) for c in counts],
            F.min(F.struct("doc_id", *counts)).alias("first"),
        )
    )
    # Written out, for both sides of a join come from it and the texts are read once.
    copies = pin(copies, "copies")
    least = (
        copies.where(~F.col("nameless"))
        .groupBy("digest")
        .agg(F.min("first.doc_id").alias("least_id"))
    )
    placed = copies.join(least, "digest", "left")
    # Rows without an id are never copies of a smaller id, nor is the least id's row.
    original = F.col("nameless") | (F.col("first.doc_id") == F.col("least_id"))

    def stays(name: str) -> Column:
        own = F.when(F.col("nameless"), F.col(name)).otherwise(F.col(f"first.{name}"))
        return F.when(original, own).otherwise(F.lit(0).cast("bigint"))

    split = placed.select(
        "part",
        F.inline(
            F.array(
                F.struct(F.col("mask").alias("mask"), *[stays(c).alias(c) for c in counts]),
                F.struct(
                    (F.col("mask") + _BIT["E"]).alias("mask"),
                    *[(F.col(c) - stays(c)).alias(c) for c in counts],
                ),
            )
        ),
    )
    return split.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in counts])


def _fold(cell: Column, order: Column) -> Column:
    """One struct per step of ``order``: what it does to the documents of a mask's ``cell``."""
    none = F.lit(0).cast("bigint")
    empty = F.array().cast(f"array<struct<{','.join(f'{m}:bigint' for m in _MEASURES)}>>")

    def step(state: Column, bit: Column) -> Column:
        alive = state["alive"]
        fails = cell["mask"].bitwiseAND(bit) != 0
        goes = alive & fails
        done = F.struct(
            F.when(alive & ~fails, cell["n"]).otherwise(none).alias("kept"),
            F.when(goes, cell["n"]).otherwise(none).alias("removed"),
            F.when(~alive & fails, cell["n"]).otherwise(none).alias("redundant"),
            F.when(cell["mask"] == bit, cell["n"])
            .otherwise(none)
            .alias("unique_fails"),
            F.when(goes, cell["good"]).otherwise(none).alias("good_lost"),
            F.when(goes, cell["toxic"]).otherwise(none).alias("toxic_lost"),
        )
        return F.struct(
            (alive & ~fails).alias("alive"),
            F.concat(state["steps"], F.array(done)).alias("steps"),
        )

    start = F.struct(F.lit(True).alias("alive"), empty.alias("steps"))
    return F.aggregate(order, start, step, lambda state: state["steps"])


def _added(a: Column, b: Column) -> Column:
    return F.struct(*[(a[m] + b[m]).alias(m) for m in _MEASURES])


def audit_masks(counted: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and the measures, out of ``part, mask, n, good, toxic``."""
    orders = F.array(*[F.array(*[F.lit(_BIT[c]) for c in o]) for o in ORDERS])
    letters = F.array(*[F.lit(LETTERS.index(c)) for o in ORDERS for c in o])
    cells = counted.groupBy("part").agg(
        # At most 32 masks a part, whatever it holds.
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")
    )
    zero = F.struct(*[F.lit(0).cast("bigint").alias(m) for m in _MEASURES])
    zeros = F.array_repeat(zero, len(ORDERS) * len(LETTERS))
    folded = cells.select(
        "part",
        F.aggregate(
            "cells",
            zeros,
            lambda total, cell: F.zip_with(
                total, F.flatten(F.transform(orders, lambda o: _fold(cell, o))), _added
            ),
        ).alias("steps"),
    )
    shares = F.transform(
        F.array(*[F.lit(i) for i in range(len(LETTERS))]),
        lambda letter: F.aggregate(
            F.zip_with(
                "steps",
                letters,
                lambda s, own: F.when(own == letter, s["removed"]).otherwise(F.lit(0).cast("bigint")),
            ),
            F.lit(0).cast("bigint"),
            lambda a, b: a + b,
        ),
    )
    rows = folded.select("part", "steps", shares.alias("shares")).select(
        "part", "shares", F.posexplode("steps").alias("at", "s")
    )
    place = F.floor(F.col("at") / len(LETTERS)).cast("int")
    names = F.array(*[F.lit(o) for o in ORDERS])
    order = F.element_at(names, place + 1)
    step = (F.col("at") % len(LETTERS) + 1).cast("int")
    at_letter = F.element_at(letters, F.col("at") + 1) + 1
    return rows.select(
        "part",
        order.alias("filter_order"),
        step.alias("step"),
        *[F.col("s")[m].alias(m) for m in _MEASURES],
        F.element_at("shares", at_letter).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """600 rows per part: each of the 120 orders of the five filters and each of its steps.

    A part is a value of ``source``, NULL counting as empty. NULL texts count as empty, with
    no words; an empty text passes B, C and D. Of equal texts only those with the least id
    pass E; rows that repeat that id pass as well. A row without an id passes E, makes no
    other row fail it, and has no label. Of several labels of an id any 1 counts; labels
    without an id count for none. Empty tables give no rows. Extra columns are ignored.
    """
    return audit_masks(masks(docs, labels))

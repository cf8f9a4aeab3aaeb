"""Quality rules whose cutoffs are certified on labelled documents.

A document's badness is the largest of a few shares, each divided by its own scale.
Documents above a cutoff go. Which cutoff holds is decided per stratum: the labelled
good documents that a cutoff would reject are counted, and the cutoff is certified only
if so few would be unlikely (by the exact binomial distribution) were its rate of false
rejections above ``RATE``. The error that is allowed in all is shared out over all strata
and cutoffs, so that with probability ``1 - RISK`` every chosen cutoff keeps its promise.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, let, words_of
from tidemark.sources.scratch import pin

RATE = 0.02  # of good documents that a cutoff may reject
RISK = 0.05  # that any cutoff breaks this
CUTOFFS = (0.25, 0.5, 1.0, 2.0, 4.0, 8.0)
STRATUM = "lang"

SYMBOLS = "#*$%&|<>"
SHOUTS = "!?"
REPEAT_WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
# What one unit of badness is, per word or line.
SCALES = {"symbols": 0.1, "shouts": 0.2, "dup_lines": 0.3, "repeat_words": 0.1}


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """How many words lie in a window of words that the text holds twice or more."""
    starts = F.sequence(F.lit(0), F.size(words) - F.lit(window))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + F.lit(1), window)))

    def covered(at: Column) -> Column:
        steps = F.transform(
            at, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(at, i + F.lit(1)) - p, F.lit(window)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def twins(ordered: Column) -> Column:
        def same(entry: Column, i: Column) -> Column:
            before, after = F.get(ordered, i - F.lit(1))["h"], F.get(ordered, i + F.lit(1))["h"]
            own = entry["h"]
            return F.coalesce(before == own, F.lit(False)) | F.coalesce(after == own, F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, same), lambda e: e["at"]))

    def count(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at")))
        found = let(F.sort_array(placed), lambda ordered: let(twins(ordered), covered))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(found)

    return F.when(F.size(words) > window, let(hashes, count)).otherwise(F.lit(0)).cast("bigint")


def measures(text: Column) -> Column:
    """A struct of counts over a whole text, its ``base_failed`` verdict and its ``badness``.

    NULL is a text without words or lines.
    """
    text = F.coalesce(text, F.lit(""))
    worded = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    lines = let(
        worded,
        lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")),
    )
    words = let(
        words_of(text),
        lambda x: F.struct(F.size(x).cast("bigint").alias("n"), repeated_words(x).alias("repeated")),
    )
    chars = F.char_length(text)

    def counts(line: Column, word: Column) -> Column:
        def row(raw: Column) -> Column:
            share = F.greatest(raw["n_words"], F.lit(1)).cast("double")
            of_lines = F.greatest(raw["n_lines"], F.lit(1)).cast("double")
            bad = F.greatest(
                raw["n_symbols"] / share / F.lit(SCALES["symbols"]),
                raw["n_shouts"] / share / F.lit(SCALES["shouts"]),
                raw["n_dup_lines"] / of_lines / F.lit(SCALES["dup_lines"]),
                raw["n_repeat_words"] / share / F.lit(SCALES["repeat_words"]),
            )
            failed = (raw["n_words"] < F.lit(LEAST_WORDS)) | (
                raw["n_repeat_words"] * F.lit(100) > raw["n_words"] * F.lit(MOST_REPEATED_PERCENT)
            )
            return F.struct(
                raw.alias("counts"), failed.alias("base_failed"), bad.alias("badness")
            )

        raw = F.struct(
            word["n"].alias("n_words"),
            F.char_length(_without(text, SPACES)).cast("bigint").alias("word_chars"),
            (chars - F.char_length(_without(text, SYMBOLS))).cast("bigint").alias("n_symbols"),
            (line["n"] - line["distinct"]).cast("bigint").alias("n_dup_lines"),
            word["repeated"].alias("n_repeat_words"),
            (chars - F.char_length(_without(text, SHOUTS))).cast("bigint").alias("n_shouts"),
            line["n"].cast("bigint").alias("n_lines"),
        )
        return let(raw, row)

    return let(lines, lambda line: let(words, lambda word: counts(line, word)))


def log_factorial(n: Column) -> Column:
    """``ln n!``: exact up to 20, beyond by Stirling's series, good to full double precision."""
    x = n.cast("double")
    series = (
        x * F.ln(x) - x + F.lit(0.5) * F.ln(F.lit(2 * pi) * x) + F.lit(1 / 12) / x
        - F.lit(1 / 360) / F.pow(x, F.lit(3)) + F.lit(1 / 1260) / F.pow(x, F.lit(5))
    )
    small = F.ln(F.factorial(F.least(n, F.lit(20)).cast("int")))
    return F.when(n <= 20, small).otherwise(series)


def at_most(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X binomial with ``n`` draws of ``rate``; 1 where ``k`` exceeds the mean.

    The sum runs down from ``k`` until its terms, which fall off faster than a normal
    curve's, are far below double precision.
    """
    p = F.lit(rate)
    top = (
        log_factorial(n) - log_factorial(k) - log_factorial(n - k)
        + k * F.ln(p) + (n - k) * F.ln(F.lit(1.0) - p)
    )
    terms = F.least(k, F.ceil(F.lit(12.0) * F.sqrt(n * p)) + F.lit(60))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))

    def add(state: Column, j: Column) -> Column:
        ratio = (k - j) * (F.lit(1.0) - p) / ((n - k + j + F.lit(1)) * p)
        return F.struct(
            (state["term"] * ratio).alias("term"),
            (state["total"] + state["term"]).alias("total"),
        )

    relative = F.aggregate(F.sequence(F.lit(0).cast("bigint"), terms), start, add, lambda s: s["total"])
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.exp(top) * relative)


def certified_cutoffs(
    labelled: DataFrame,
    cutoffs: Sequence[float] = CUTOFFS,
    rate: float = RATE,
    risk: float = RISK,
) -> DataFrame:
    """``stratum, cutoff`` from ``labelled (stratum, badness, quality)``, one row per stratum that has one.

    Of a stratum's certified cutoffs the one is taken that rejects most bad documents
    beyond the good ones that it costs, of equals the loosest. A stratum with too few labels to certify any gets no row.
    Every stratum and every cutoff counts as a test of its own.
    """
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    above = [F.col("badness") > F.lit(float(c)) for c in cutoffs]
    counted = labelled.groupBy("stratum").agg(
        F.count_if(good).alias("n"),
        *(F.count_if(good & a).alias(f"false{i}") for i, a in enumerate(above)),
        *(F.count_if(bad & a).alias(f"right{i}") for i, a in enumerate(above)),
    )
    # One row per stratum, so a window over all of them is small.
    strata = F.count("*").over(W.partitionBy(F.lit(1)))
    tests = counted.withColumn("tests", strata * F.lit(len(cutoffs))).select(
        "stratum",
        "n",
        "tests",
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(float(c)).alias("cutoff"),
                        F.col(f"false{i}").alias("wrong"),
                        F.col(f"right{i}").alias("right"),
                    )
                    for i, c in enumerate(cutoffs)
                )
            )
        ).alias("test"),
    )
    chance = at_most(F.col("test.wrong"), F.col("n"), rate)
    passed = tests.where((F.col("n") > 0) & (chance <= F.lit(risk) / F.col("tests")))
    gain = (F.col("test.right") - F.col("test.wrong")).alias("gain")
    best = F.max(F.struct(gain, "test.cutoff"))
    return passed.groupBy("stratum").agg(best.alias("best")).select("stratum", "best.cutoff")


def _judged(docs: DataFrame, labels: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The measured rows, written once, and the cutoffs certified on those with a label."""
    measured = pin(docs.withColumn("measured", measures(F.col("text"))).drop("text"), label)
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    # A document is good only if all its labels say so.
    known = known.dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
    holdout = measured.where(~F.col("measured.base_failed")).join(known, "doc_id")
    rows = holdout.select("stratum", F.col("measured.badness").alias("badness"), "quality")
    cutoffs = certified_cutoffs(rows)
    # Written out, so that Spark knows its size when it picks the join.
    return measured, pin(cutoffs.withColumnRenamed("stratum", "held"), "cutoffs")


def _verdict() -> Column:
    above = F.coalesce(F.col("measured.badness") > F.col("cutoff"), F.lit(False))
    return ~F.col("measured.base_failed") & ~above


def judge(docs: DataFrame, labels: DataFrame, stratum: str = STRATUM) -> DataFrame:
    """Counts, ``badness``, the stratum's ``cutoff`` and ``kept`` for every row of ``docs``.

    ``labels`` is ``(doc_id, quality)`` with 1 for good. NULL strata are one stratum;
    rows without an id are judged but teach nothing; repeated rows are each judged, and
    all count where they have a label. No labels at all: only the base rules reject.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col(stratum).cast("string").alias("stratum"),
    )
    measured, cutoffs = _judged(rows, labels, "measured")
    joined = measured.join(cutoffs, F.col("stratum").eqNullSafe(F.col("held")), "left")
    return joined.select(
        "doc_id",
        "measured.counts.*",
        "measured.base_failed",
        _verdict().alias("kept"),
        "measured.badness",
        "cutoff",
    )


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = STRATUM) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col(stratum).cast("string").alias("stratum"),
        F.struct(*docs.columns).alias("whole"),
    )
    measured, cutoffs = _judged(rows, labels, "measured-documents")
    joined = measured.join(cutoffs, F.col("stratum").eqNullSafe(F.col("held")), "left")
    return joined.where(_verdict()).select("whole.*")

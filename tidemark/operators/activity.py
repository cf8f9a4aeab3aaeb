"""Active days per key, packed into bit words, and distinct counts over them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.days import between_days

_EPOCH = date(1970, 1, 1).toordinal()
WORD = 60  # days per word; leaves the sign bit of a 64-bit value unused


def _bit(index: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), index.cast("int"))


def active_days(df: DataFrame, key: str = "user_id", day: str = "event_date") -> DataFrame:
    """The distinct (key, day) pairs."""
    return df.select(key, day).distinct()


def day_words(df: DataFrame, key: str, day: str) -> DataFrame:
    """(key, word, bits): bit ``i`` of word ``w`` is set when day ``60 w + i`` was active.

    Days count from 1970-01-01. All rows of a key within a word collapse to one
    row inside each task, so the shuffle does not grow with events per key.
    """
    number = F.unix_date(F.col(day))
    word = F.floor(number / F.lit(WORD)).cast("int")
    return (
        df.where(F.col(day).isNotNull())
        .groupBy(F.col(key), word.alias("word"))
        .agg(F.bit_or(_bit(F.pmod(number, F.lit(WORD)))).alias("bits"))
    )


def sliding_distinct(
    df: DataFrame,
    first: date,
    last: date,
    days: int,
    key: str = "user_id",
    day: str = "event_date",
    name: str = "mau",
    daily_name: str | None = None,
) -> DataFrame:
    """Distinct keys active in the ``days`` days up to each date in ``first..last``.

    One shuffle brings a key's active days together as bit words; every date is
    then a mask test on them, so no pair of date and event is ever built. Dates
    without any active key yield no row. ``daily_name`` adds the distinct keys of
    the date itself.
    """
    origin = date.fromordinal(first.toordinal() - days + 1)
    span = last.toordinal() - origin.toordinal() + 1
    words = -(-span // WORD)
    offset = F.datediff(F.col(day), F.lit(origin))
    packed = (
        df.where(between_days(day, origin, last) & F.col(key).isNotNull())
        .select(F.col(key), offset.alias("offset"))
        .groupBy(key)
        .agg(
            *(
                F.bit_or(
                    F.when(
                        F.col("offset").between(w * WORD, w * WORD + WORD - 1),
                        _bit(F.col("offset") - F.lit(w * WORD)),
                    ).otherwise(F.lit(0).cast("bigint"))
                ).alias(f"w{w}")
                for w in range(words)
            )
        )
    )
    return _count_windows(packed, origin, words, first, last, days, name, daily_name)


def sliding_distinct_of_words(
    words: DataFrame,
    first: date,
    last: date,
    days: int,
    key: str = "user_id",
    name: str = "mau",
    daily_name: str | None = None,
) -> DataFrame:
    """:func:`sliding_distinct` from stored rows of :func:`day_words` instead of from events.

    Only the words that overlap the days in question are read.
    """
    low = (first.toordinal() - days + 1 - _EPOCH) // WORD
    high = (last.toordinal() - _EPOCH) // WORD
    none = F.lit(0).cast("bigint")
    packed = (
        words.where(F.col("word").between(low, high) & F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            *(
                F.bit_or(F.when(F.col("word") == w, F.col("bits")).otherwise(none)).alias(f"w{w - low}")
                for w in range(low, high + 1)
            )
        )
    )
    origin = date.fromordinal(low * WORD + _EPOCH)
    return _count_windows(packed, origin, high - low + 1, first, last, days, name, daily_name)


def word_of(day: date) -> int:
    """Which word holds the bit of a day."""
    return (day.toordinal() - _EPOCH) // WORD


def merge_day(kept: DataFrame, active: DataFrame, day: date, key: str = "user_id") -> DataFrame:
    """``(key, bits)`` of a word after the keys ``active`` on ``day`` have been put in.

    ``kept`` holds the word's rows of before. Whatever it says of the day is taken back
    first, so a rerun of the day with other keys gives the same as if they had been the first.
    """
    bit = 1 << (day.toordinal() - _EPOCH) % WORD
    others = kept.select(key, F.col("bits").bitwiseAND(F.lit(~bit)).alias("bits"))
    own = active.where(F.col(key).isNotNull()).select(key, F.lit(bit).cast("bigint").alias("bits"))
    merged = others.unionByName(own).groupBy(key).agg(F.bit_or("bits").alias("bits"))
    return merged.where(F.col("bits") != 0)


def _count_windows(
    packed: DataFrame,
    origin: date,
    words: int,
    first: date,
    last: date,
    days: int,
    name: str,
    daily_name: str | None,
) -> DataFrame:
    """Count per date the keys of ``packed (w0, w1, …)``, whose bits count days from ``origin``."""
    # One mask row per date, as a literal array: every test runs where ``packed`` is produced.
    masks = []
    for ordinal in range(first.toordinal(), last.toordinal() + 1):
        end = ordinal - origin.toordinal()
        bits = [f"{_mask(end - days + 1, end, w)}L, {_mask(end, end, w)}L" for w in range(words)]
        masks.append(f"(DATE'{date.fromordinal(ordinal)}', {', '.join(bits)})")
    fields = ", ".join(f"m{w}, d{w}" for w in range(words))
    in_window = " OR ".join(f"(w{w} & m{w}) != 0" for w in range(words))
    on_day = " OR ".join(f"(w{w} & d{w}) != 0" for w in range(words))
    counts = [F.count("*").alias(name)]
    if daily_name:
        counts.append(F.expr(f"count_if({on_day})").alias(daily_name))
    return (
        packed.selectExpr(
            *(f"w{w}" for w in range(words)),
            f"inline(array{'(' + ', '.join(masks) + ')'}) AS (metric_date, {fields})",
        )
        .where(in_window)
        .groupBy("metric_date")
        .agg(*counts)
    )


def _mask(low: int, high: int, word: int) -> int:
    """Bits of the days ``low..high`` that fall into ``word``."""
    start, stop = max(low - word * WORD, 0), min(high - word * WORD, WORD - 1)
    return ((1 << (stop - start + 1)) - 1) << start if start <= stop else 0

"""As-of join: facts and versions of a key merged in one stream ordered by time.

A range condition on top of an equality makes every fact meet every version of its key. Here
both are sorted once, together, and the last version seen is carried on to the facts behind
it, so a key costs its facts plus its versions. Keys with very many facts are cut into time
ranges at quantiles of their facts; each range also gets the version that is valid when it
begins, so ranges are independent of one another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.skew import hot_keys

# Cuts are searched in blocks of so many.
_BLOCK = 32


def time_cuts(facts: DataFrame, key: str, ts: str, hot: dict) -> dict[object, list[int]]:
    """Per key of ``hot`` the instants, in microseconds, that split its rows into its pieces.

    One pass over the rows of hot keys alone, with sketches of quantiles merged by Spark.
    Their number is bounded by the pieces, whatever the number of rows. Instants repeat where
    one holds more rows than a piece should.
    """
    pieces = max(hot.values(), default=1)
    if pieces == 1:
        return {}
    shares = [i / pieces for i in range(1, pieces)]
    rows = (
        facts.where(F.col(key).isin(list(hot)) & F.col(ts).isNotNull())
        .groupBy(key)
        .agg(F.percentile_approx(_micros(ts), shares, 10 * pieces).alias("cuts"))
        .collect()
    )
    # Pieces are powers of two, so each key takes every so many of the quantiles.
    return {r[key]: r.cuts[pieces // hot[r[key]] - 1 :: pieces // hot[r[key]]] for r in rows if hot[r[key]] > 1}


def _micros(ts: str | Column) -> Column:
    at = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), at)


def _cut_table(rows: DataFrame, key: str, cuts: dict[object, list[int]]) -> DataFrame:
    kind = rows.schema[key].dataType
    longs = T.ArrayType(T.LongType())
    schema = T.StructType(
        [
            T.StructField("__cut_key", kind),
            T.StructField("__heads", longs),
            T.StructField("__blocks", T.ArrayType(longs)),
        ]
    )
    data = []
    for item, own in cuts.items():
        blocks = [own[i : i + _BLOCK] for i in range(0, len(own), _BLOCK)]
        data.append((item, [b[0] for b in blocks], blocks))
    return rows.sparkSession.createDataFrame(data, schema)


def _cuts_before(at: Column) -> Column:
    """How many of the row's cuts lie before the instant ``at``."""
    block = F.size(F.filter("__heads", lambda c: c < at))
    inside = F.size(F.filter(F.get("__blocks", block - 1), lambda c: c < at))
    return F.when(block > 0, (block - 1) * _BLOCK + inside).otherwise(F.lit(0))


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    start: str,
    stop: str,
    take: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] = (),
    hot: dict | None = None,
) -> DataFrame:
    """Add the columns ``take`` of the version valid at each fact's time.

    A version is valid from ``start`` until before ``stop``; those of a key must not overlap.
    Both are timestamps without a zone, as is ``ts``. Facts without such a version are
    dropped, or kept with NULLs when ``how="left"``, which includes those without a key or a
    time. ``hot`` is what :func:`hot_keys` found for the facts; ``spread_by`` names columns
    that tell a hot key's facts of one instant apart. Columns of ``take`` may not have the
    name of a column of the facts.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    if hot is None:
        hot = hot_keys(facts, key)
    usable = F.col(key).isNotNull() & F.col(ts).isNotNull()
    columns = facts.columns
    timed = facts.where(usable).select("*", _micros(ts).alias("__at"))
    kept = versions.where(F.col(key).isNotNull() & (F.col(start) < F.col(stop))).select(
        F.col(key).alias("__key"),
        _micros(start).alias("__at"),
        F.struct(_micros(stop).alias("__stop"), *take).alias("__version"),
    )
    cuts = time_cuts(facts, key, ts, hot)
    if cuts:
        table = _cut_table(facts, key, cuts)
        timed = timed.join(table, F.col(key) == F.col("__cut_key"), "left")
        kept = kept.join(table, F.col("__key") == F.col("__cut_key"), "left")
        before, within = _cuts_before(F.col("__at")), _cuts_before(F.col("__at") + 1)
        # Facts at an instant that is cut more than once share the pieces between its cuts.
        spread = F.pmod(F.xxhash64(*(spread_by or columns)), within - before + 1).cast("int")
        known = F.col("__cut_key").isNotNull()
        timed = timed.withColumn("__piece", F.when(known, before + spread).otherwise(F.lit(0)))
        last = _cuts_before(F.col("__version.__stop"))
        span = F.when(known, F.sequence(before, last)).otherwise(F.array(F.lit(0)))
        kept = kept.withColumn("__piece", F.explode(span))
    else:
        timed, kept = (df.withColumn("__piece", F.lit(0)) for df in (timed, kept))
    none = F.lit(None)
    version_type = kept.schema["__version"].dataType
    # The key travels once, as __key.
    others = [c for c in columns if c != key]
    stream = timed.select(
        F.col(key).alias("__key"),
        "__piece",
        "__at",
        F.lit(True).alias("__fact"),
        none.cast(version_type).alias("__version"),
        *others,
    ).unionByName(
        kept.select(
            "__key",
            "__piece",
            "__at",
            F.lit(False).alias("__fact"),
            "__version",
            *(none.cast(facts.schema[c].dataType).alias(c) for c in others),
        )
    )
    # Versions come before the facts of the instant at which they start.
    so_far = (
        W.partitionBy("__key", "__piece")
        .orderBy("__at", "__fact")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    carried = stream.withColumn("__held", F.last("__version", ignorenulls=True).over(so_far))
    valid = F.col("__held.__stop") > F.col("__at")
    out = [F.when(valid, F.col("__held")[c]).alias(c) for c in take]
    merged = carried.where(F.col("__fact")).withColumn(key, F.col("__key").cast(facts.schema[key].dataType))
    if how == "inner":
        return merged.where(valid).select(*columns, *out)
    rest = facts.where(~usable).select(
        *columns, *(none.cast(versions.schema[c].dataType).alias(c) for c in take)
    )
    return merged.select(*columns, *out).unionByName(rest)

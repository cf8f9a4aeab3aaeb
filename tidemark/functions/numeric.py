"""Rounding and safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round a double half up by plain binary arithmetic.

    ``round`` on doubles goes through decimal text in Spark and through binary
    arithmetic elsewhere; this form gives the same answer everywhere.
    """
    scale = 10**digits
    return F.floor(value.cast("double") * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def ratio_pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` unrounded, NULL when ``whole`` is zero."""
    return part.cast("double") / F.nullif(whole, F.lit(0)) * F.lit(100)


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a rounded percentage of ``whole``, NULL when ``whole`` is zero."""
    scale = 10**digits
    share = part.cast("double") / F.nullif(whole, F.lit(0))
    return F.floor(share * F.lit(100 * scale) + F.lit(0.5)) / F.lit(scale)

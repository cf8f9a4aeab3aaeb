"""JSON fields, product numbers and ISO timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_text(doc: Column, field: str) -> Column:
    """One top-level field of a JSON document as text, NULL when absent."""
    return F.get_json_object(doc, f"$.{field}")


def to_json_text(doc: Column, dtype: T.DataType) -> Column:
    """JSON text of a nested value; text passes through unchanged."""
    return doc if isinstance(dtype, T.StringType) else F.to_json(doc)


def product_number(product_id: Column) -> Column:
    """The number in a product id such as ``PRD_0007``; NULL when there is none."""
    return F.substr(product_id, F.lit(5)).try_cast("int")


def utc_timestamp(text: Column) -> Column:
    """Parse an ISO timestamp, with or without a fraction, to a zone-free UTC value.

    Text without an offset is read as UTC, whatever the session time zone.
    """
    has_offset = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    zoned = F.when(has_offset, text).otherwise(F.concat(text, F.lit("Z")))
    micros = F.unix_micros(zoned.try_cast("timestamp"))
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))

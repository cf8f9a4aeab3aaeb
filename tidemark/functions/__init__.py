"""Column expressions shared by the operators and plans."""

from tidemark.functions.containment import json_contains
from tidemark.functions.numeric import pct, ratio_pct, round_half_up
from tidemark.functions.text import (
    json_text,
    product_number,
    to_json_text,
    utc_timestamp,
)

__all__ = [
    "json_contains",
    "json_text",
    "pct",
    "product_number",
    "ratio_pct",
    "round_half_up",
    "to_json_text",
    "utc_timestamp",
]

"""Containment of one JSON value in another, at any depth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Json = Mapping | Sequence | str | int | float | Decimal | bool | None


def json_contains(doc: Column, wanted: Json) -> Column:
    """Whether the JSON text ``doc`` holds all of ``wanted``.

    An object holds another if it has each of its keys with a value that holds the other's;
    further keys do not matter. An array holds another if each of the other's items is held
    by some item of it; order, repeats and further items do not matter. Scalars hold their
    equals only: text is no number, and ``1``, ``1.0`` and ``1e0`` are the same one. At the
    top alone an array also holds a scalar that is one of its items.

    The shape of ``wanted`` is known when the plan is made, so it becomes one expression.
    NULL for NULL and for text that is not JSON, or repeats a key within an object. Numbers
    of more than 38 digits or with an exponent are compared as doubles.
    """
    value = F.try_parse_json(doc)
    held = _holds(value, wanted)
    if not isinstance(wanted, (Mapping, list, tuple)):
        held = held | _some_item(value, wanted)
    return F.when(value.isNotNull(), held)


def _holds(value: Column, wanted: Json) -> Column:
    if isinstance(wanted, Mapping):
        fields = F.try_variant_get(value, "$", "map<string,variant>")
        each = [_holds(F.try_element_at(fields, F.lit(k)), w) for k, w in wanted.items()]
        return reduce(Column.__and__, each, fields.isNotNull())
    if isinstance(wanted, (list, tuple)):
        each = [_some_item(value, w) for w in wanted]
        return reduce(Column.__and__, each, _items(value).isNotNull())
    return _is(value, wanted)


def _items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _some_item(value: Column, wanted: Json) -> Column:
    return F.coalesce(F.exists(_items(value), lambda item: _holds(item, wanted)), F.lit(False))


def _is(value: Column, wanted: Json) -> Column:
    """Equality with a scalar; False for a missing value."""
    kind = F.schema_of_variant(value)
    if wanted is None:
        same = kind == "VOID"
    elif isinstance(wanted, bool):
        same = (kind == "BOOLEAN") & (F.try_variant_get(value, "$", "boolean") == F.lit(wanted))
    elif isinstance(wanted, str):
        same = (kind == "STRING") & (F.try_variant_get(value, "$", "string") == F.lit(wanted))
    else:
        # Exact numbers have no final zeros, so equal ones have equal text.
        exact = format(Decimal(str(wanted)).normalize(), "f")
        as_text = F.try_variant_get(value, "$", "string") == F.lit("0" if exact == "-0" else exact)
        as_double = F.try_variant_get(value, "$", "double") == F.lit(float(wanted))
        same = F.when(kind == "DOUBLE", as_double).otherwise(
            ((kind == "BIGINT") | kind.startswith("DECIMAL")) & as_text
        )
    return F.coalesce(same, F.lit(False))

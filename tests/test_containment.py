"""JSON containment against a plain recursive definition."""

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import json_contains


def same(a, b):
    if isinstance(a, bool) or isinstance(b, bool) or a is None or b is None:
        return a is b
    if isinstance(a, str) or isinstance(b, str):
        return type(a) is type(b) and a == b
    return isinstance(a, (int, Decimal)) and isinstance(b, (int, Decimal)) and a == b


def holds(doc, wanted, top=True):
    if isinstance(wanted, dict):
        return isinstance(doc, dict) and all(k in doc and holds(doc[k], w, False) for k, w in wanted.items())
    if isinstance(wanted, list):
        return isinstance(doc, list) and all(any(holds(d, w, False) for d in doc) for w in wanted)
    if isinstance(doc, list):
        return top and any(same(d, wanted) for d in doc if not isinstance(d, (list, dict)))
    return not isinstance(doc, dict) and same(doc, wanted)


def a_value(rng, depth):
    pick = rng.random()
    if depth and pick < 0.3:
        keys = rng.sample(["a", "b.c", "d'e", 'f"g', "", "é", "$", "a[0]"], rng.randint(0, 3))
        return {k: a_value(rng, depth - 1) for k in keys}
    if depth and pick < 0.6:
        return [a_value(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([1, 0, -2, Decimal("1.5"), Decimal("0.10"), "1", "x", "", True, False, None])


def a_part(rng, doc):
    """Something that ``doc`` holds, most of the time."""
    if isinstance(doc, dict):
        return {k: a_part(rng, v) for k, v in doc.items() if rng.random() < 0.7}
    if isinstance(doc, list):
        kept = [a_part(rng, v) for v in doc if rng.random() < 0.7]
        rng.shuffle(kept)
        return kept + kept[:1]
    return doc if rng.random() < 0.9 else a_value(rng, 1)


def as_text(rng, value):
    """JSON text with numbers written in one of several ways."""
    if isinstance(value, dict):
        return "{" + ", ".join(f"{json.dumps(k)}:{as_text(rng, v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(as_text(rng, v) for v in value) + " ]"
    if isinstance(value, (int, Decimal)) and not isinstance(value, bool):
        exact = Decimal(value)
        ways = [str(value), format(exact, "f") + ("0" if "." in str(value) else ".0"), f"{exact * 10}e-1"]
        return rng.choice(ways)
    return json.dumps(value)


def test_random_documents_and_patterns(spark):
    rng = random.Random(11)
    docs = [a_value(rng, 3) for _ in range(150)]
    patterns = [a_part(rng, rng.choice(docs)) for _ in range(20)] + [a_value(rng, 2) for _ in range(10)]
    rows = [(i, as_text(rng, d)) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "i int, d string")
    hits = 0
    for start in range(0, len(patterns), 10):
        part = patterns[start : start + 10]
        held = [json_contains(F.col("d"), p).alias(f"p{j}") for j, p in enumerate(part)]
        for row in df.select("i", *held).collect():
            want = [holds(docs[row.i], p) for p in part]
            assert list(row)[1:] == want, (docs[row.i], part)
            hits += sum(want)
    assert hits > 100


@pytest.mark.parametrize(
    ("doc", "wanted", "held"),
    [
        ('{"a":{"b":1,"c":2},"d":3}', {"a": {"c": 2}}, True),
        ('{"a":{"b":1}}', {"b": 1}, False),
        ('{"a.b":"x"}', {"a.b": "x"}, True),
        ('{"a":{"b":"x"}}', {"a.b": "x"}, False),
        ("[1,2,[1,3]]", [1, 3], False),
        ("[1,2,[1,3]]", [[3]], True),
        ("[1,2,2]", [2, 1, 1], True),
        ('["foo","bar"]', "bar", True),
        ('"bar"', ["bar"], False),
        ('{"a":["bar"]}', {"a": "bar"}, False),
        ("{}", {}, True),
        ("[]", {}, False),
        ("[[]]", [], True),
        ('{"a":null}', {"a": None}, True),
        ("{}", {"a": None}, False),
        ('{"n":1.0}', {"n": 1}, True),
        ('{"n":"1"}', {"n": 1}, False),
        ('{"n":1}', {"n": True}, False),
        ('{"n":100}', {"n": 1e2}, True),
        ('{"n":1E+2}', {"n": 100}, True),
        ('{"n":-0.0}', {"n": 0}, True),
        ('{"n":0.12345678901234567890123456}', {"n": Decimal("0.12345678901234567890123457")}, False),
        ("not json", {"a": 1}, None),
        ('{"a":1,"a":2}', {"a": 2}, None),
        (None, {}, None),
    ],
)
def test_cases(spark, doc, wanted, held):
    df = spark.createDataFrame([(doc,)], "d string")
    assert df.select(json_contains(F.col("d"), wanted)).first()[0] is held


def test_works_as_a_filter(spark):
    df = spark.createDataFrame([('{"payment_gateway":"stripe","v":[1]}',), ('{"v":[]}',), (None,)], "d string")
    assert df.where(json_contains(F.col("d"), {"payment_gateway": "stripe"})).count() == 1
    assert df.where(~json_contains(F.col("d"), {"v": [1]})).count() == 1

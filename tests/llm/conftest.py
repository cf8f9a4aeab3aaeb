import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """A documents table from ids and texts, or from longer tuples."""

    def build(rows):
        whole = []
        for doc_id, text, *rest in rows:
            lang, source = [*rest, *("en", "src0")[len(rest) :]]
            whole.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(whole, DOCUMENTS)

    return build


@pytest.fixture
def odd_documents(documents):
    """NULLs in every column, empty, blank and very long texts, repeated rows and ids."""
    long = " ".join(f"word{i % 977} and thing{i % 31}" for i in range(20_000))
    return documents(
        [
            (1, None),
            (2, ""),
            (3, " \t\n "),
            (4, "one"),
            (5, long),
            (5, long),
            (6, long + " more"),
            (7, "the cat sat on the mat and the dog ran to the old red barn by the sea", None, None),
            (7, "the cat sat on the mat and the dog ran to the old red barn by the sea", None, None),
            (None, "the cat sat on the mat and the dog ran to the old red barn by the sea"),
            (None, None, None, None),
            (8, "x" * 50_000),
            (9, "línea única ñandú 東京 日本   wide space 🙂", "es", "src1"),
        ]
    )


@pytest.fixture
def clashing(odd_documents):
    """Extra columns named like ones that operators derive."""
    from pyspark.sql import functions as F

    names = ["fp", "fingerprint", "component_id", "words", "target", "kept", "row", "n", "score"]
    names += ["tokens", "leaf", "slot", "unit", "rows", "least_id", "cut", "epoch", "value"]
    return odd_documents.withColumns({n: F.lit("x") for n in names})


@pytest.fixture
def no_documents(documents):
    return documents([])

import zlib

import numpy as np
from conftest import SF

from tidemark.llm import langid, queries

BIG = "/root/testdata/sf0.01"


def plain_vector(text, dimensions=langid.DIMENSIONS):
    """Bundle letter by letter, without tables."""
    vectors = langid.NgramVectors(dimensions)
    codes = [ord(c) if c.isalpha() else 0 for c in text.lower()]
    if not any(codes):
        return None
    line = [0]
    for c in [*codes, 0]:
        if c or line[-1]:
            line.append(c)
    total = np.zeros(dimensions)
    for a, b, c in zip(line, line[1:], line[2:], strict=False):
        total += np.roll(vectors.letter(a), 2) * np.roll(vectors.letter(b), 1) * vectors.letter(c)
    return total


def test_accuracy_on_held_out_rows(spark):
    truth = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang")
    rows = queries.op8_language_id(spark, BIG).join(truth, "doc_id").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    right = sum(r.lang == r.lang_pred for r in held) / len(held)
    assert right >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_prediction_equals_plain_vectors(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    bundles = {}
    for doc_id, text, lang in rows:
        if zlib.crc32(str(doc_id).encode()) % 3 != 1 and (v := plain_vector(text)) is not None:
            bundles[lang] = bundles.get(lang, 0) + v
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    for doc_id, text, _ in rows[:25]:
        v = plain_vector(text)
        cosines = {k: float(v @ b) / np.linalg.norm(v) / np.linalg.norm(b) for k, b in bundles.items()}
        best = max(cosines, key=cosines.get)
        assert abs(got[doc_id].score - max(cosines.values())) < 1e-3
        if sorted(cosines.values())[-1] - sorted(cosines.values())[-2] > 1e-3:
            assert got[doc_id].lang_pred == best


def test_only_rows_that_are_not_held_out_teach(documents):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1]
    rows = [(i, "quel temps fait il", "fr") for i in ids]
    rows += [(i, "what is the weather", "en") for i in range(60) if i not in ids]
    found = langid.identify(documents(rows)).collect()
    assert {r.lang_pred for r in found} == {"en"}


def test_odd_rows(odd_documents):
    rows = langid.identify(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by_id[i].lang_pred for i in (1, 2, 3)} == {"und"}
    assert {by_id[i].score for i in (1, 2, 3)} == {0.0}
    assert by_id[9].lang_pred != "und"


def test_many_scripts_beyond_the_table(documents):
    text = "".join(chr(0x4E00 + i * 7 % 20_000) for i in range(30_000))
    rows = [(i, text, "zh") for i in range(3)] + [(i, "the weather is fine", "en") for i in range(3, 9)]
    found = {r.doc_id: r.lang_pred for r in langid.identify(documents(rows)).collect()}
    assert found[0] == "zh" and found[5] == "en"


def test_no_rows(no_documents):
    assert langid.identify(no_documents).collect() == []


def test_extra_columns(clashing):
    assert langid.identify(clashing).count() == clashing.count()

import re
from collections import Counter
from itertools import permutations

from conftest import SF
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import filter_audit

LABELS = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "quality", "toxic")])


def brute(docs, labels):
    """Every document through every order."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, text, _ in docs:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    fails = []
    for d, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        capitals = sum("A" <= c <= "Z" for c in text)
        fails.append(
            {
                "A": len(words) < 50,
                "B": 100 * len(set(words)) < 65 * len(words),
                "C": 100 * capitals > 5 * len(text),
                "D": bool(re.search(r"[#$%&*|]", text)),
                "E": d is not None and d > least[text],
            }
        )
    out, shapley = {}, Counter()
    parts = {s or "" for _, _, s in docs}
    orders = ["".join(p) for p in permutations("ABCDE")]
    for part in parts:
        for order in orders:
            for step in range(1, 6):
                out[part, order, step] = Counter()
    for (d, _, source), own in zip(docs, fails, strict=True):
        part = source or ""
        for order in orders:
            gone = False
            for step, c in enumerate(order, 1):
                cell = out[part, order, step]
                if own[c] and not gone:
                    cell["removed"] += 1
                    cell["good_lost"] += d in good
                    cell["toxic_lost"] += d in toxic
                    shapley[part, c] += 1
                elif own[c]:
                    cell["redundant"] += 1
                cell["unique_fails"] += own[c] and sum(own.values()) == 1
                gone = gone or own[c]
                cell["kept"] += not gone
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return {
        key: (*[cell[n] for n in names], shapley[key[0], key[1][key[2] - 1]]) for key, cell in out.items()
    }


def audited(docs, labels):
    rows = filter_audit.audit(docs, labels).collect()
    found = {tuple(r)[:3]: tuple(r)[3:] for r in rows}
    assert len(found) == len(rows)
    return found


def plain(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]


def test_against_every_document_in_every_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    assert audited(docs, labels) == brute(plain(docs), known)


def test_odd_rows_and_clashing_columns(spark, clashing):
    known = [(5, 1, 0), (5, 0, 1), (6, 1, 1), (None, 1, 1), (7, None, 1), (999, 1, 1), (4, 0, None)]
    labels = spark.createDataFrame(known, LABELS).withColumn("spread", F.lit("x"))
    docs = clashing.withColumns({n: F.lit("x") for n in ("part", "mask", "digest", "spread", "n", "good")})
    found = audited(docs, labels)
    assert found == brute(plain(docs), known)
    assert {k[0] for k in found} == {"", "src0", "src1"} and len(found) == 1800


def test_copies_across_parts_and_a_hot_part(spark, documents):
    text = "same words again " * 30
    rows = [(i, text, "en", f"src{i % 3}") for i in range(400, 0, -1)] + [(1, text, "en", "src2")]
    rows += [(None, text, "en", "src0")] * 50 + [(1000 + i, f"own {i} #", "en", "src0") for i in range(30)]
    known = [(i, i % 2, i % 5 == 0) for i in range(1, 400)]
    labels = spark.createDataFrame([(a, b, int(c)) for a, b, c in known], LABELS)
    docs = documents(rows)
    assert audited(docs, labels) == brute(plain(docs), known)


def test_no_rows(spark, no_documents, odd_documents):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(no_documents, none).collect() == []
    assert len(filter_audit.audit(odd_documents, none).collect()) == 1800

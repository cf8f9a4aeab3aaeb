import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidemark.llm import context_tree, lm_scores
from tidemark.llm.byte_grams import ByteGrams


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def lowered(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)


class PlainTree:
    """A context tree per decision, by its recursive definition."""

    def __init__(self, texts, depth):
        self.depth = depth
        self.counts = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)
        for text in texts:
            for context, byte in self.steps(text):
                for before, bit in self.bits(byte):
                    for d in range(depth + 1):
                        self.counts[before, context[depth - d :]][bit] += 1
                        if d:
                            parent = context[depth - d + 1 :]
                            self.children[before, parent].add(context[depth - d :])
        self.known = {}

    def steps(self, text):
        line = b"\xfe" * self.depth + text + b"\xff"
        for i in range(self.depth, len(line)):
            yield line[i - self.depth : i], line[i]

    def bits(self, byte):
        text = f"{byte:08b}"
        return [(text[:i], int(text[i])) for i in range(8)]

    def mixed(self, before, context):
        key = before, context
        if key not in self.known:
            own = log_kt(*self.counts[key])
            if len(context) < self.depth:
                longer = sum(self.mixed(before, c) for c in self.children[key])
                top = max(own, longer)
                own = top + math.log(0.5 * math.exp(own - top) + 0.5 * math.exp(longer - top))
            self.known[key] = own
        return self.known[key]

    def one(self, before, context, d=0):
        key = before, context[self.depth - d :]
        zeros, ones = self.counts.get(key, (0, 0))
        estimate = (ones + 0.5) / (zeros + ones + 1)
        if d == self.depth:
            return estimate
        if key not in self.counts:
            return 0.5
        weight = math.exp(math.log(0.5) + log_kt(zeros, ones) - self.mixed(*key))
        return weight * estimate + (1 - weight) * self.one(before, context, d + 1)

    def score(self, text):
        total = 0.0
        for context, byte in self.steps(text):
            for before, bit in self.bits(byte):
                p = self.one(before, context)
                total += math.log10(p if bit else 1 - p)
        return total


def check(docs, depth=5):
    rows = [(r.doc_id, lowered(r.text)) for r in docs.select("doc_id", "text").collect()]
    taught = [t for d, t in rows if not is_held(d)]
    counts = Counter(w for t in taught for w in t.split())
    n, v = sum(counts.values()) + len(taught), len(counts) + bool(taught)
    model = PlainTree(taught, depth)
    want = []
    for doc_id, text in rows:
        c = [*(counts[w] for w in text.split()), len(taught)]
        base = sum(math.log10((x + 1) / (n + v + 1)) for x in c)
        want.append((doc_id, is_held(doc_id), len(c), sum(x > 0 for x in c), n, base, model.score(text)))
    found = [tuple(r) for r in lm_scores.scores(docs).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    assert len(found) == len(want)
    for a, b in zip(sorted(found, key=order), sorted(want, key=order), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-6)
    return found


def test_against_the_recursive_definition(documents, monkeypatch):
    """Several chunks and buckets, repeated rows, several scripts."""
    monkeypatch.setattr(lm_scores, "BUCKET_BYTES", 300)
    rng = random.Random(4)
    words = "the cat sat on a mat École straße 東京 naïve THE And of, by. 🙂".split()
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(60)]
    rows += [(3, "the  cat\nsat\ton"), (3, "the  cat\nsat\ton"), (None, "no id"), (70, None), (71, ""), (72, " \n ")]
    docs = documents(rows).repartition(3)
    found = check(docs)
    assert {r[1] for r in found} == {True, False}


def test_chunks_of_several_parts(documents, monkeypatch):
    """Parts share their chunk's answers; held-out and empty texts make parts of their own."""
    monkeypatch.setattr(lm_scores, "BUCKET_BYTES", 300)
    monkeypatch.setattr(lm_scores, "CHUNK_BYTES", 700)
    monkeypatch.setattr(lm_scores, "PART_BYTES", 150)
    rng = random.Random(5)
    words = "one ONE two three École 東京 a a, 🙂".split()
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(60)]
    rows += [(80, "x" * 400), (81, "long " * 300), (82, None), (83, " \n "), (84, ""), (None, "no id")]
    check(documents(rows).repartition(2))


def test_a_task_holds_the_positions_of_one_part(monkeypatch):
    """Of 6 MB that are one chunk, looked at in parts of 256 KB, before and after."""
    monkeypatch.setattr(lm_scores, "PART_BYTES", 256 << 10, raising=False)
    monkeypatch.setattr(lm_scores, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=500)) for _ in range(2000)]
    docs = pa.RecordBatch.from_pydict({"doc_id": range(2000), "out": [False] * 2000, "text": texts})
    size = sum(map(len, texts))
    assert size < lm_scores.CHUNK_BYTES
    tracemalloc.start()
    try:
        rows = [r for b in lm_scores._gather(2)(iter([docs])) for r in b.to_pylist()]
        assert tracemalloc.get_traced_memory()[1] < 7 * size
    finally:
        tracemalloc.stop()
    assert {r["chunk"] for r in rows} == {0}
    assert sum(r["kind"] == "text" for r in rows) == math.ceil(size / (256 << 10))
    taught = [lm_scores._unpack(r["more"], "<i8").sum() for r in rows if r["kind"] == "gram"]
    assert sum(taught) == size + 2000


@pytest.mark.parametrize("places", [1, 2, 12, 51, 211, 3000])
def test_chunks_are_dealt_out_evenly(places):
    step = lm_scores._stride(places)
    for tasks, made in ((1, 3 * places), (places, 2), (max(places // 3, 1), 7)):
        loads = Counter((task + k * step) % places for task in range(tasks) for k in range(made))
        assert max(loads.values()) <= math.ceil(tasks * made / places) + 1


def test_documents_that_nothing_teaches(documents):
    held = [i for i in range(60) if is_held(i)]
    found = check(documents([(i, "some words") for i in held]))
    assert {r[4] for r in found} == {0}
    assert found[0][6] == pytest.approx(11 * math.log10(1 / 256))


def test_odd_rows_and_clashing_columns(clashing):
    docs = clashing.withColumns({n: F.lit("x") for n in ("held_out", "kind", "chunk", "bucket", "n", "body")})
    short = docs.where(F.coalesce(F.length("text"), F.lit(0)) < 1000)
    check(short)
    rows = lm_scores.scores(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[8].n_tokens == 2 and by_id[8].n_bytes == 50_000 and by_id[8].score < 0
    assert by_id[5].score == [r.score for r in rows if r.doc_id == 5][1]


def test_no_rows(no_documents):
    assert lm_scores.scores(no_documents).collect() == []


def test_contexts_help_on_held_out_documents(spark):
    """Far fewer bits a byte than the best code without contexts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lm_scores.scores(docs).where("held_out").collect()
    texts = [lowered(r.text) + b"\xff" for r in docs.select("doc_id", "text").collect() if is_held(r.doc_id)]
    counts = Counter(b"".join(texts))
    total = sum(counts.values())
    assert total == sum(r.n_bytes + 1 for r in rows)
    alone = -sum(n * math.log2(n / total) for n in counts.values()) / total
    assert -sum(r.score for r in rows) * math.log2(10) / total < 0.75 * alone


@pytest.mark.parametrize("table", [1 << 25, 50])
def test_runs_are_numbered_in_order(monkeypatch, table):
    from tidemark.llm import byte_grams

    monkeypatch.setattr(byte_grams, "_TABLE", table)
    rng = random.Random(table)
    for texts in ([], [b""], [b"", b"a", b""], [bytes(rng.choices(b"abc \xc3", k=n)) for n in (500, 3, 0, 900)]):
        data = np.frombuffer(b"".join(b"\xfe" * 5 + t + b"\xff" for t in texts), np.uint8)
        grams = ByteGrams(data, 6)
        runs = [int.from_bytes(data[i : i + 6].tobytes(), "big") for i in range(max(len(data) - 5, 0))]
        assert grams.keys.tolist() == sorted(set(runs))
        assert grams.keys[grams.ids].tolist() == runs


def test_estimates_of_large_counts():
    zeros, ones = np.array([0.0, 3, 5000, 1e9]), np.array([0.0, 0, 4000, 2e9])
    want = [log_kt(a, b) for a, b in zip(zeros, ones, strict=True)]
    assert context_tree.log_estimate(zeros, ones) == pytest.approx(want, rel=1e-9, abs=1e-12)

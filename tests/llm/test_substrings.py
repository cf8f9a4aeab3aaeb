import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from conftest import SF

from tidemark.llm import queries, substrings


def plain(rows, window=13):
    """Per row: id, number of words, removed places."""
    least = {}
    split = []
    for doc_id, text in rows:
        words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
        split.append(words)
        if doc_id is not None:
            for i in range(len(words) - window + 1):
                key = tuple(words[i : i + window])
                least[key] = min(least.get(key, doc_id), doc_id)
    out = []
    for (doc_id, _), words in zip(rows, split, strict=True):
        gone = set()
        if doc_id is not None:
            for i in range(len(words) - window + 1):
                if least[tuple(words[i : i + window])] < doc_id:
                    gone.update(range(i, i + window))
        out.append((doc_id, words, gone))
    return out


def digest(rows):
    return sorted(
        (
            (d, len(w), len(g), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in g).encode()).hexdigest())
            for d, w, g in plain(rows)
        ),
        key=repr,
    )


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op9_substring_dedup(spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=repr) == digest([tuple(r) for r in rows])


def spans(found):
    return sorted(
        ((r.doc_id, r.n_words, tuple((s.start, s.length) for s in r.repeats), r.kept_text) for r in found.collect()),
        key=repr,
    )


def wanted_spans(rows, window=13):
    out = []
    for d, words, gone in plain(rows, window):
        runs = []
        for i in sorted(gone):
            if runs and runs[-1][0] + runs[-1][1] == i:
                runs[-1][1] += 1
            else:
                runs.append([i, 1])
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), tuple((s, n) for s, n in runs), kept))
    return sorted(out, key=repr)


def test_planted_passages(documents):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    passages = [[rng.choice(words) for _ in range(rng.randint(5, 40))] for _ in range(30)]
    rows = []
    for i in rng.sample(range(1000), 150):
        text = []
        for _ in range(rng.randint(0, 6)):
            text += rng.choice(passages) if rng.random() < 0.5 else rng.choices(words, k=rng.randint(1, 20))
        rows.append((i, " ".join(text)))
    rows += [rows[0], (rows[1][0], rows[2][1])]
    assert spans(substrings.repeats(documents(rows))) == wanted_spans(rows)
    small = substrings.repeats(documents(rows), window=5, prefix=3, groups=3)
    assert spans(small) == wanted_spans(rows, 5)


def test_low_variety(documents):
    rows = [(i, " ".join("ab"[(i * j) % 2] for j in range(40 + i))) for i in range(12)]
    assert spans(substrings.repeats(documents(rows))) == wanted_spans(rows)


def test_odd_rows(odd_documents):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    assert spans(substrings.repeats(odd_documents)) == wanted_spans(rows)


def test_kept_columns(clashing):
    names = [c for c in clashing.columns if c not in ("doc_id", "text")]
    found = substrings.repeats(clashing, *names, with_text=True)
    assert found.columns[: len(names) + 2] == ["doc_id", "text", *names]
    key = ["doc_id", "text", "lang", "source", "n_chars", "fp"]
    assert sorted(map(repr, found.select(key).collect())) == sorted(map(repr, clashing.select(key).collect()))


def test_no_rows(no_documents):
    assert substrings.repeats(no_documents).collect() == []


def test_a_group_is_read_in_parts(monkeypatch):
    """Its words are never in memory together, and the parts find what the whole finds."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdef", k=5)) for _ in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=1000)) for _ in range(300)]
    texts[7], texts[9], texts[11] = texts[3], None, texts[5][:3000] + " other " + texts[6]
    ids = [None if i == 20 else i for i in range(300)]
    docs = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())})
    words = substrings.Words(docs.column(1).combine_chunks())
    _, places, grams = substrings.anchors(words)
    owners = np.array([i or 0 for i in ids], np.int64)[words.owner[places]]
    hits = [substrings._pack(grams[places], owners.view(np.uint64))]
    n_words = len(words.hashes)
    del words, places, grams, owners

    def removed():
        group = substrings._Group(docs, hits, 13, 7)
        return group.removed(np.zeros(len(group.high), bool)).tolist()

    whole = removed()
    assert sum(whole) >= 2000
    monkeypatch.setattr(substrings, "_TEXT_BYTES", 1 << 16)
    assert removed() == whole
    tracemalloc.start()
    try:
        substrings._Group(docs, [], 13, 7)
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak < 24 * n_words

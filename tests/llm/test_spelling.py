import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidemark.llm import spelling


def brute(docs):
    counted = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counted[word] += 1
    words = {w: n for w, n in counted.items() if len(w) >= 5 and n >= 3}
    letters = sorted({c for w in words for c in w})
    near, form = {}, {}
    for w in words:
        ends = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        made = {a + c + b for a, b in ends for c in letters}
        for a, b in ends[:-1]:
            made |= {a + b[1:]} | {a + c + b[1:] for c in letters}
        near[w] = [x for x in made if x in words and x != w]
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def grouped(docs):
    rows = spelling.group_variants(docs).collect()
    assert rows == [] or rows[0].__fields__ == ["word", "form", "root", "n", "n_near", "form_n"]
    found = {tuple(r)[0]: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def plain(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_against_all_edits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = grouped(docs)
    assert found == brute(plain(docs)) and len(found) > 1000


@pytest.mark.parametrize("block", [3, 1000])
def test_dense_words_in_small_blocks(documents, monkeypatch, block):
    """Few letters, so that runs of equal letters, chains and ties abound."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    rng = random.Random(block)
    rows = []
    for i in range(150):
        words = ["".join(rng.choice("aaabÀÿ") for _ in range(rng.randint(4, 8))) for _ in range(60)]
        rows.append((i, " ".join(words).upper() if i % 2 else "-".join(words)))
    docs = documents(rows)
    found = grouped(docs)
    assert found == brute(plain(docs))
    assert any(f is not None and r != f for f, r, *_ in found.values())


def test_only_latin_capitals_are_lowered(documents):
    found = grouped(documents([(i, "ÉCOLE École STRASSE straße ÷×÷×÷ 12345") for i in range(3)]))
    assert {"École".replace("É", "É"), "École"[0] + "cole", "strasse", "straße", "÷×÷×÷"} >= set(found) - {"École"}
    assert found["École"][2] == 6


def test_odd_rows_and_clashing_columns(clashing):
    docs = clashing.withColumns({n: F.lit("x") for n in ("id", "word", "path", "form", "n_near")})
    assert grouped(docs) == brute(plain(docs))


def test_very_long_words(documents):
    long = "xy" * 20_000
    found = grouped(documents([(i, f"{long} {long}z") for i in range(3)] + [(9, long), (10, long), (11, long)]))
    assert found[long][2:4] == (6, 1) and found[long + "z"] == (long, long, 3, 1, 6)


def test_no_rows(no_documents, documents):
    assert grouped(no_documents) == {}
    assert grouped(documents([(1, "seldom words only"), (2, None)])) == {}

import zlib
from array import array
from collections import Counter

import corpus_pipeline
from conftest import SF

from tidemark.llm import mixing, packing

from . import test_mixing, test_packing, test_quality_rules, test_simhash, test_substrings

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(rows, labels):
    """Base rules, then cutoffs by counting."""
    judged = []
    for r in rows:
        words, _, symbols, dup, repeated, failed = test_quality_rules.plain(r["text"])
        lines = [x for x in (r["text"] or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        shouts = sum(c in "!?" for c in r["text"] or "")
        per, of = max(words, 1), max(len(lines), 1)
        bad = max(symbols / per / 0.1, shouts / per / 0.2, dup / of / 0.3, repeated / per / 0.1)
        judged.append((r, failed, bad))
    holdout = [(r["lang"], bad, labels[r["doc_id"]]) for r, failed, bad in judged if not failed and r["doc_id"] in labels]
    cutoffs = test_quality_rules.plain_cutoffs(holdout, (0.25, 0.5, 1.0, 2.0, 4.0, 8.0), 0.02, 0.05)
    return [r for r, failed, bad in judged if not failed and not bad > cutoffs.get(r["lang"], float("inf"))]


def unlike(rows):
    found = {d: c for d, _, c in test_simhash.expected([(r["doc_id"], r["text"]) for r in rows])}
    return [r for r in rows if found[r["doc_id"]] == r["doc_id"]]


def shortened(rows):
    out = []
    for r, (_, words, gone) in zip(rows, test_substrings.plain([(r["doc_id"], r["text"]) for r in rows]), strict=True):
        if gone:
            text = " ".join(w for i, w in enumerate(words) if i not in gone)
            r = {**r, "text": text, "n_chars": len(text)}
        out.append(r)
    return out


def mixed(rows):
    keys = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows]
    chosen = test_mixing.plain_mix(keys, corpus_pipeline.MIX_SHARE, corpus_pipeline.MIX_EPOCHS)
    kept = {doc_id for doc_id, _, _ in chosen}
    return [r for r in rows if r["doc_id"] in kept]


def packed(rows):
    out = Counter()
    for r in rows:
        ids, start = [*test_packing.ids_of(r["text"]), 1], 0
        for length in packing.piece_lengths(len(ids)):
            part = array("I", ids[start : start + length]).tobytes()
            out[(r["doc_id"], start, length, zlib.crc32(part), len(ids))] += 1
            start += length
    return out


def table(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_every_stage_and_the_whole_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r.asDict() for r in docs.collect()]
    plain = [lambda r: good(r, labels), unlike, shortened, mixed]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["good_documents", "near_duplicates", "repeated_passages", "target_mix", "pack"]
    for (name, stage), step in zip(corpus_pipeline.STAGES[:-1], plain, strict=True):
        path = folder(name)
        stage(spark, docs, SF).write.parquet(path)
        before = rows
        docs, rows = spark.read.parquet(path), step(rows)
        assert docs.columns == COLUMNS
        assert table(docs) == sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=repr)
        assert rows != before
    whole = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in whole) == packed(rows)
    assert sorted(r.sequence_id for r in whole) == list(range(len(whole)))


def test_stages_take_odd_and_no_rows(spark, clashing, no_documents, folder):
    for start in (clashing, no_documents):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            path = folder(name)
            stage(spark, docs, SF).write.parquet(path)
            if name != "pack":
                assert spark.read.parquet(path).columns == start.columns
            docs = spark.read.parquet(path)
    assert mixing.EPOCHS > corpus_pipeline.MIX_EPOCHS

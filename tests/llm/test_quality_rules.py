import random
import re
from math import comb, exp, lgamma, log

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    counts = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    return (*counts, len(words) < 10 or 100 * len(covered) > 20 * len(words))


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int")


def test_counts(spark, documents):
    rng = random.Random(2)
    texts = [None, "", " \n ", "a b c d e a b c d e", "x " * 30, "a\na\n\n \n \nb\na ", "one # two $%& <|>"]
    for _ in range(60):
        texts.append("".join(rng.choice(["a", "b", "ñ", " ", " ", "\n", "\t", "*", "wörd "]) for _ in range(rng.randint(0, 120))))
    rows = list(enumerate(texts))
    got = quality_rules.judge(documents(rows), labels(spark, [])).collect()
    assert {r.doc_id: (*(r[c] for c in COUNTS), r.base_failed) for r in got} == {i: plain(t) for i, t in rows}
    assert all(r.kept == (not r.base_failed) for r in got)


def exact(k, n, rate):
    return sum(comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1))


def test_binomial_tail(spark):
    cases = [(k, n, r) for r in (0.01, 0.05, 0.3) for n in (1, 5, 21, 60, 300) for k in range(0, n + 1) if k <= n * r]
    for rate in (0.01, 0.05, 0.3):
        own = [(k, n) for k, n, r in cases if r == rate]
        df = spark.createDataFrame(own, "k bigint, n bigint")
        for row in df.withColumn("p", quality_rules.at_most(F.col("k"), F.col("n"), rate)).collect():
            assert row.p == pytest.approx(exact(row.k, row.n, rate), rel=1e-9)


def test_binomial_tail_of_many(spark):
    n, k, rate = 3_000_000, 29_500, 0.01
    row = spark.createDataFrame([(k, n)], "k bigint, n bigint").select(quality_rules.at_most(F.col("k"), F.col("n"), rate).alias("p")).first()
    logs = [lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(rate) + (n - i) * log(1 - rate) for i in range(k - 9000, k + 1)]
    assert row.p == pytest.approx(sum(map(exp, logs)), rel=1e-4)


def plain_cutoffs(rows, cutoffs, rate, risk):
    strata = {s for s, _, _ in rows}
    out = {}
    for stratum in strata:
        good = [b for s, b, q in rows if s == stratum and q == 1]
        bad = [b for s, b, q in rows if s == stratum and q == 0]
        passed = []
        for c in cutoffs:
            wrong = sum(b > c for b in good)
            if good and wrong <= rate * len(good) and exact(wrong, len(good), rate) <= risk / (len(strata) * len(cutoffs)):
                passed.append((sum(b > c for b in bad) - wrong, c))
        if passed:
            out[stratum] = max(passed)[1]
    return out


def test_cutoffs(spark):
    rng = random.Random(9)
    rows = []
    for stratum, n in (("en", 3000), ("de", 900), ("fr", 40), (None, 700), ("xx", 0)):
        rows += [(stratum, abs(rng.gauss(0, 0.4)), 1) for _ in range(n)] + [(stratum, rng.uniform(0, 9), 0) for _ in range(n // 5 + 3)]
    df = spark.createDataFrame(rows, "stratum string, badness double, quality int")
    for rate in (0.01, 0.05):
        got = quality_rules.certified_cutoffs(df, rate=rate).collect()
        wanted = plain_cutoffs(rows, quality_rules.CUTOFFS, rate, quality_rules.RISK)
        assert {r.stratum: r.cutoff for r in got} == wanted
        assert "fr" not in wanted and "en" in wanted


def test_promise_holds_on_new_rows(spark):
    """Over many draws, a chosen cutoff rejects too many good documents seldom."""
    rng = random.Random(1)
    rows, over = [], 0
    for draw in range(200):
        rows += [(str(draw), rng.expovariate(3.0), 1) for _ in range(400)] + [(str(draw), 9.0, 0)]
    df = spark.createDataFrame(rows, "stratum string, badness double, quality int")
    for r in quality_rules.certified_cutoffs(df, rate=0.05).collect():
        over += exp(-3.0 * r.cutoff) > 0.05
    assert over <= 200 * quality_rules.RISK


def test_junk_goes_and_clean_stays(spark, documents):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    rows, known = [], []
    for i in range(1800):
        words = [word() for _ in range(30)]
        junk = i % 6 == 0
        rows.append((i, " ".join(w + ("%%%" if junk else "") for w in words)))
        if i % 3 < 2:
            known.append((i, int(not junk)))
    kept = {r.doc_id: r.kept for r in quality_rules.judge(documents(rows), labels(spark, known)).collect()}
    assert all(kept[i] == (i % 6 != 0) for i in range(1800))
    stays = quality_rules.keep_good(documents(rows), labels(spark, known))
    assert stays.columns == documents(rows).columns
    assert sorted(r.doc_id for r in stays.collect()) == [i for i in range(1800) if i % 6]


def test_odd_rows(spark, odd_documents, clashing, no_documents):
    some = labels(spark, [(5, 1), (5, 0), (None, 1), (7, None), (99, 1), (1, 1), (1, 1)])
    got = quality_rules.judge(odd_documents, some).collect()
    texts = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    short = [(d, t) for d, t in texts if t is None or len(t) < 1000]
    wanted = sorted(((d, *plain(t)) for d, t in short), key=repr)
    ids = {d for d, _ in short}
    assert sorted(((r.doc_id, *(r[c] for c in COUNTS), r.base_failed) for r in got if r.doc_id in ids and r.n_words < 1000), key=repr) == wanted
    assert quality_rules.keep_good(clashing, some).columns == clashing.columns
    assert quality_rules.judge(no_documents, some).collect() == []
    assert quality_rules.keep_good(no_documents, labels(spark, [])).collect() == []

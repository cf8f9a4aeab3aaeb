import hashlib
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import mixing

BIG = "/root/testdata/sf0.01"


def plain_fill(budget, children):
    """Hand out in rounds: ``children`` is {name: (capacity, weight)}."""
    given, open_ = {}, {n for n, (_, w) in children.items() if w > 0}
    while open_:
        weights = sum(children[n][1] for n in open_)
        left = budget - sum(given.values())
        level = left / weights
        full = {n for n in open_ if children[n][0] / children[n][1] <= level}
        if not full:
            for n in open_:
                given[n] = min(children[n][0], int(level * children[n][1] + 1e-9))
            break
        # One at a time, the one that fills up first.
        n = min(full, key=lambda n: (children[n][0] / children[n][1], n))
        given[n] = children[n][0]
        open_.remove(n)
    return given


def plain_budgets(leaves, total, epochs):
    """leaves: {(domain, lang, source): (tokens, (wd, wl, ws))}."""
    budget = {(): min(total, epochs * sum(t for t, _ in leaves.values()))}
    for depth in range(3):
        following = {}
        for node, amount in budget.items():
            children = defaultdict(lambda: [0, 0])
            for leaf, (tokens, weights) in leaves.items():
                if leaf[:depth] == node:
                    children[leaf[: depth + 1]][0] += epochs * tokens
                    children[leaf[: depth + 1]][1] = weights[depth]
            following |= plain_fill(amount, children)
        budget = following
    return budget


def test_budgets_equal_rounds(spark):
    rng = random.Random(8)
    for _ in range(4):
        leaves = {}
        wd, wl = {d: rng.randint(1, 9) for d in "abc"}, {x: rng.randint(1, 9) for x in "xyz"}
        for d in "abc":
            for lang in "xyz":
                for s in range(rng.randint(0, 4)):
                    tokens = rng.choice([0, 5, 50, 500, 5000]) * rng.randint(1, 9)
                    leaves[(d, lang, f"s{s}")] = (tokens, (wd[d], wl[lang], rng.randint(1, 3)))
        rows = [(*k, t, *w) for k, (t, w) in leaves.items()]
        names = "domain string, lang string, source string, tokens bigint, weight_domain bigint, weight_lang bigint, weight_source bigint"
        total = rng.randint(0, 60_000)
        got = mixing.budgets(spark.createDataFrame(rows, names), F.lit(total).cast("bigint"), 2)
        wanted = plain_budgets(leaves, total, 2)
        found = {(r.domain, r.lang, r.source): r.budget for r in got.collect()}
        assert found.keys() == wanted.keys()
        assert all(abs(found[k] - wanted[k]) <= 1 for k in wanted)


def test_shortage_goes_to_siblings_first(spark):
    rows = [("a", "x", "s1", 10), ("a", "x", "s2", 10_000), ("a", "y", "s3", 10_000), ("b", "x", "s4", 10_000)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens bigint")
    same = dict.fromkeys(["weight_domain", "weight_lang", "weight_source"], F.lit(1).cast("bigint"))
    got = mixing.budgets(leaves.withColumns(same), F.lit(4000).cast("bigint"), 1).collect()
    assert {r.source: r.budget for r in got} == {"s1": 10, "s2": 990, "s3": 1000, "s4": 2000}
    rows[1] = ("a", "x", "s2", 20)
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens bigint")
    got = mixing.budgets(leaves.withColumns(same), F.lit(4000).cast("bigint"), 1).collect()
    assert {r.source: r.budget for r in got} == {"s1": 10, "s2": 20, "s3": 1970, "s4": 2000}


def plain_mix(rows, share, epochs, seed=mixing.SEED):
    """rows: (doc_id, text, lang, source); returns (doc_id, epoch, taken) with repeats."""
    domains = dict(enumerate(mixing.DOMAINS))
    by_leaf = defaultdict(list)
    for doc_id, text, lang, source in rows:
        number = source[3:] if source and source.startswith("src") and source[3:].isdigit() else None
        domain = domains.get(int(number) // 5, "other") if number is not None else "other"
        leaf = (domain, lang or "", source or "")
        by_leaf[leaf].append((doc_id, text or ""))
    weights = lambda d, x: (mixing.DOMAIN_WEIGHTS.get(d, 5), mixing.LANG_WEIGHTS.get(x, 5), 1)
    size = lambda text: len(text.split())
    leaves = {k: (sum(size(t) for _, t in v), weights(k[0], k[1])) for k, v in by_leaf.items()}
    total = int(sum(t for t, _ in leaves.values()) * share)
    out = []
    for leaf, budget in plain_budgets(leaves, total, epochs).items():
        used = 0
        places = []
        for epoch in range(epochs):
            for doc_id, text in by_leaf[leaf]:
                tie = hashlib.md5(text.encode()).hexdigest()
                key = f"{seed}|{epoch}|{tie if doc_id is None else doc_id}"
                places.append((epoch, hashlib.md5(key.encode()).hexdigest(), tie, doc_id, size(text)))
        for epoch, _, _, doc_id, tokens in sorted(places, key=lambda p: p[:3]):
            if used >= budget and (tokens or used > budget):
                break
            out.append((doc_id, epoch, min(tokens, budget - used)))
            used += tokens
    return Counter(out)


def test_mix_equals_running_sums(documents):
    rng = random.Random(12)
    rows = []
    for i in range(600):
        source = rng.choice(["src0", "src0", "src0", "src3", "src7", "src12", "src17", "src99", "other", None])
        lang = rng.choice(["en", "en", "de", "fr", "es", "it", None])
        rows.append((i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 40]))), lang, source))
    rows += rows[:5]
    for share, epochs in ((0.6, 2), (5.0, 3), (0.0, 1)):
        chosen = mixing.mix(mixing.leaves_of(documents(rows)), share, epochs).collect()
        assert Counter((r.doc_id, r.epoch, r.taken) for r in chosen) == plain_mix(rows, share, epochs)


def test_budgets_are_spent_to_the_token(spark):
    """But for rounding, one token at most per node, and however long the documents are."""
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    rows = mixing.leaves_of(docs)
    total = int(rows.agg(F.sum("tokens")).first()[0] * mixing.SHARE)
    spent = mixing.mix(rows).agg(F.sum("taken")).first()[0]
    assert total * 0.995 <= spent <= total


def test_the_text_decides_the_place_of_rows_without_an_id(documents):
    rows = [(None, f"text {i} " * 5, "en", "src0") for i in range(300)]
    chosen = mixing.mix(mixing.leaves_of(documents(rows)), 0.5, 1).collect()
    assert Counter((r.doc_id, r.epoch, r.taken) for r in chosen) == plain_mix(rows, 0.5, 1)
    assert len({r.tie for r in chosen}) == len(chosen)


def test_odd_rows(odd_documents, clashing, no_documents):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text", "lang", "source").collect()]
    got = mixing.mix(mixing.leaves_of(odd_documents), 1.0, 1).collect()
    assert Counter((r.doc_id, r.epoch, r.taken) for r in got) == plain_mix(rows, 1.0, 1)
    kept = mixing.keep_mixed(clashing, 1.0, 1)
    assert kept.columns == clashing.columns
    assert kept.count() == len(got)
    assert mixing.mix(mixing.leaves_of(no_documents)).collect() == []
    assert mixing.keep_mixed(no_documents, 0.5, 1).collect() == []

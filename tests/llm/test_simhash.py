import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from conftest import SF

from tidemark.llm import queries, simhash


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=4):
    """Component of each place by comparing everything with everything."""
    distinct = sorted(set(prints))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    return [find(f) for f in prints]


def expected(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    groups = defaultdict(list)
    for (doc_id, _), part in zip(rows, plain_components(prints), strict=True):
        groups[part].append(doc_id)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    parts = plain_components(prints)
    return sorted(
        ((d, f"{f:016x}", least[p]) for (d, _), f, p in zip(rows, prints, parts, strict=True)),
        key=repr,
    )


def found(df):
    rows = simhash.near_duplicates(df)
    rows = rows.select("doc_id", simhash.hex_fingerprint().alias("f"), "component_id")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op3_simhash_near_dedup(spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected([tuple(r) for r in rows])


def test_odd_rows(odd_documents):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    assert found(odd_documents) == expected(rows)


def test_no_rows(no_documents):
    assert found(no_documents) == []
    assert simhash.keep_one(no_documents).collect() == []


def test_extra_columns_stay(clashing):
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == [1, 4, 5, 7, 8, 9, None, None] or ids == sorted(
        [1, 4, 5, 7, 8, 9, None, None], key=repr
    )


@pytest.mark.parametrize("blocks", [6, 7, 8])
@pytest.mark.parametrize("limit", [4, 10_000])
def test_links_connect_what_brute_force_connects(spark, blocks, limit):
    rng = random.Random(blocks)
    prints = []
    for _ in range(25):
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 30])):
            prints.append(at)
            for _ in range(rng.randint(1, 5)):
                at ^= 1 << rng.randrange(64)
    prints = sorted(set(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    links = [tuple(r) for r in simhash.links(nodes, limit=limit, blocks=blocks).collect()]
    where = {f: i for i, f in enumerate(signed)}
    root = list(range(len(signed)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        assert (prints[where[a]] ^ prints[where[b]]).bit_count() <= 4
        root[find(where[a])] = find(where[b])
    wanted = plain_components(prints)
    assert len({(find(i), w) for i, w in enumerate(wanted)}) == len(set(wanted))
    assert len({find(i) for i in range(len(prints))}) == len(set(wanted))


def test_references_are_spread():
    refs = simhash.references()
    assert len(set(refs)) == len(refs)
    assert {(a ^ b).bit_count() for a in refs for b in refs if a != b} == {32}


def test_blocks_follow_the_count():
    assert simhash.block_count(1000) == 6
    assert simhash.block_count(10**9) > simhash.block_count(10**6)

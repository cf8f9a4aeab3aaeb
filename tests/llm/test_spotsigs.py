import hashlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF

from tidemark.llm import queries, spotsigs


def bag_of(fingerprint):
    return Counter(fingerprint[i : i + 12] for i in range(0, len(fingerprint), 12))


def jaccard(a, b):
    either = sum((a | b).values())
    return sum((a & b).values()) / either if either else 1.0


def expected(rows):
    """Per row in order: id, length, digest of the edited text and the three fingerprints."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    texts = [t or "" for _, t in rows]
    print_of = {t: spotsigs.as_text(spotsigs.signatures(t)) for t in texts}
    out = []
    for i, ((doc_id, _), text) in enumerate(zip(rows, texts, strict=True)):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, other = print_of[text], spotsigs.as_text(spotsigs.signatures(changed))
        near = round(jaccard(bag_of(own), bag_of(other)), 9)
        after = round(jaccard(bag_of(own), bag_of(print_of[following])), 9)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        out.append((doc_id, len(text), digest, own, other, near, after))
    return sorted(out, key=repr)


def found(df):
    return sorted(
        (
            (r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
            for r in df.collect()
        ),
        key=repr,
    )


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op1_document_fingerprints(spark, SF)
    assert found(got) == expected([tuple(r) for r in rows])


def test_fingerprints_tell_edits_from_others(spark):
    rows = queries.op1_document_fingerprints(spark, SF).where("n_signatures >= 20").collect()
    edits = [r.near_edited for r in rows]
    others = [r.near_next for r in rows]
    assert np.mean(edits) > 0.2
    assert np.median(others) < 0.02


def plain_signatures(text, chain=2):
    """Chains by walking word after word."""
    words = []
    for token in text.lower().split():
        while token and not token[0].isalnum():
            token = token[1:]
        while token and not token[-1].isalnum():
            token = token[:-1]
        if token:
            words.append(token)
    chains = []
    for i in range(-1, len(words)):
        if i < 0 or words[i] in spotsigs.ANCHORS:
            content = [w for w in words[i + 1 :] if w not in spotsigs.ANCHORS][:chain]
            if len(content) == chain:
                chains.append(("" if i < 0 else words[i], *content))
    return Counter(chains)


def test_signatures_stand_for_chains():
    texts = [
        "The cat, and the dog! ran to the old red barn (by the sea).",
        "a the of", "--- !!!", "one two", "one two three", "the the big bad wolf",
        "un gato y el perro; le chat et la souris --- der Hund und die Katze",
    ]
    for text in texts:
        chains = plain_signatures(text)
        bag = bag_of(spotsigs.as_text(spotsigs.signatures(text)))
        wanted = sorted(chains.values()) or [1]
        assert sorted(bag.values()) == wanted
    same = spotsigs.signatures("The  cat and THE dog ran home"), spotsigs.signatures("the cat, and the dog ran home.")
    assert np.array_equal(*same)


@pytest.mark.parametrize("least", [0.0, 0.3, 0.8])
def test_pruning_changes_nothing_above_the_least(least):
    rng = np.random.default_rng(4)
    for _ in range(400):
        pool = rng.integers(0, 30, rng.integers(0, 40)).astype(np.uint64)
        a, b = np.sort(pool[: rng.integers(0, len(pool) + 1)]), np.sort(pool[rng.integers(0, len(pool) + 1) :])
        whole = jaccard(Counter(a.tolist()), Counter(b.tolist()))
        assert spotsigs.likeness(a, b, least) == pytest.approx(whole if whole >= least else 0.0)


def test_odd_rows(odd_documents):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    assert found(spotsigs.against_edits(odd_documents)) == expected(rows)


def test_one_row_and_none(documents, no_documents):
    assert found(spotsigs.against_edits(documents([(4, "the only text")]))) == expected([(4, "the only text")])
    assert spotsigs.against_edits(no_documents).collect() == []


def test_extra_columns(clashing):
    assert spotsigs.against_edits(clashing).count() == clashing.count()


def test_equal_texts_have_equal_fingerprints(documents):
    rows = spotsigs.fingerprints(documents([(1, "a the of"), (2, "a the of"), (3, None), (4, "")])).collect()
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[1] == prints[2] != "" and prints[3] == prints[4] == ""


def unanchored(seed, n, space=" "):
    rng = np.random.default_rng(seed)
    return space.join(f"w{i}x" for i in rng.integers(0, 5000, n))


def near(a, b):
    return spotsigs.likeness(spotsigs.signatures(a), spotsigs.signatures(b))


def test_texts_without_anchors_have_signatures_all_over():
    base = unanchored(1, 600).split()
    changed = list(base)
    changed[0], changed[300] = "other", "different"
    half = base[:300] + unanchored(2, 300).split()
    tail = base[:2] + unanchored(3, 598).split()
    whole = " ".join(base)
    assert len(spotsigs.signatures(whole)) >= 600 / spotsigs.SPARSE
    assert near(whole, " ".join(changed)) > 0.9
    assert 0.2 < near(whole, " ".join(half)) < 0.5
    assert near(whole, " ".join(tail)) < 0.05
    # What stands in front does not move the chosen words.
    assert near(whole, "some more words " + whole) > 0.9


def test_every_long_run_of_content_words_has_a_signature():
    rng = np.random.default_rng(5)
    for _ in range(300):
        content = rng.integers(0, 6, rng.integers(1, 60)).astype(np.uint64) * np.uint64(2)
        starts = np.sort(rng.integers(0, len(content) + 1, rng.integers(0, 5)))
        own = spotsigs._own_anchors(content, np.concatenate(([0], starts)))
        edges = [0, *starts.tolist(), len(content)]
        for low, high in zip(edges, edges[1:], strict=False):
            inside = [i for i in own.tolist() if low <= i and i + 1 < high]
            if high - low > spotsigs.SPARSE:
                gaps = np.diff([low - 1, *inside, high - 1])
                assert inside and gaps.max() <= spotsigs.SPARSE
            else:
                assert not inside


@pytest.mark.parametrize("make", [
    lambda r: "".join(chr(0x4E00 + i) for i in r.integers(0, 3000, 600)),
    lambda r: ";".join(f"f{i}(x{i})" for i in r.integers(0, 3000, 300)),
    lambda r: "".join(chr(97 + i) for i in r.integers(0, 26, 900)),
])
def test_texts_without_blanks(make):
    text, other = make(np.random.default_rng(1)), make(np.random.default_rng(2))
    half = len(text) // 2
    assert len(spotsigs.signatures(text)) > 40
    assert near(text, text[:half] + other[half:]) > 0.2
    assert near(text, other) < 0.05


def test_no_long_document_hangs_on_one_signature(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()
    for (text,) in rows:
        words = len((text or "").split())
        if words >= 30 and len(set(text.lower().split())) > 20:
            assert len(spotsigs.signatures(text)) >= words / 30

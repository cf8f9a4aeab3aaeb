import random
import re

import pytest

from tidemark.llm import licenses


def plain_grams(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\W_]+", text) if w]
    return set(zip(words, words[1:], strict=False))


def plain_scan(rows, templates=licenses.TEMPLATES, least=0.8):
    known = {n: plain_grams(t) for n, t in templates.items()}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        units = list(enumerate(lines, 1)) + ([(0, text)] if len(lines) > 1 else [])
        for unit, part in units:
            grams = plain_grams(part)
            scores = sorted(
                (-2 * len(grams & k) / (len(grams) + len(k)), n) for n, k in known.items() if grams and k
            )
            if scores and -scores[0][0] >= least:
                out.append((doc_id, unit, scores[0][1], round(-scores[0][0], 9), len(grams)))
    return sorted(out, key=repr)


def found(df):
    return sorted(
        ((r.doc_id, r.unit, r.license, round(r.dice, 9), r.n_bigrams) for r in df.collect()), key=repr
    )


def test_planted_licences(documents):
    mit, isc = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["ISC"]
    half = " ".join(mit.split()[:80])
    rows = [
        (1, f"Some text here.\nReleased under the MIT License.\nMore text."),
        (2, mit),
        (3, mit.replace(". ", ".\n")),
        (4, "Copyright 2020\n" + isc.upper()),
        (5, half),
        (6, "licensed  under CC-BY-NC 4.0!\nLicensed under CC BY 4.0"),
        (7, "This work is licensed under the GNU General Public License, version 2."),
        (8, "released under the mit license released under the mit license"),
    ]
    got = found(licenses.scan(documents(rows)))
    assert got == plain_scan(rows)
    assert {(d, u) for d, u, *_ in got} >= {(1, 2), (2, 1), (3, 0), (4, 0), (4, 2), (6, 1), (6, 2), (7, 1)}
    assert not [g for g in got if g[0] == 5]


def test_bounds_prune_no_match(documents):
    rows = [(i, " ".join(f"w{j}" for j in range(i))) for i in range(1, 40)]
    templates = {"t": " ".join(f"w{j}" for j in range(20)), "u": " ".join(f"w{j}" for j in range(5, 30))}
    for least in (0.3, 0.8, 1.0):
        got = found(licenses.scan(documents(rows), templates, least))
        assert got == plain_scan(rows, templates, least)


def test_odd_rows(odd_documents, clashing, no_documents, documents):
    assert found(licenses.scan(odd_documents)) == []
    assert licenses.scan(clashing).count() == 0
    assert licenses.scan(no_documents).collect() == []
    rows = [(None, "Released under the MIT License."), (3, "Released under the MIT License.")] * 2
    assert found(licenses.scan(documents(rows))) == plain_scan(rows)
    assert licenses.scan(documents(rows), {}).collect() == []


def test_bounds():
    assert licenses.size_bounds(10, 0.8) == (7, 15)
    assert licenses.size_bounds(10, 1.0) == (10, 10)
    with pytest.raises(ValueError):
        licenses.scan(None, least=0)


def prose(start, n):
    return " ".join(f"word{i} of the thing{i}" for i in range(start, start + n))


def wrapped(text, width=76, prefix=""):
    import textwrap

    return "\n".join(prefix + line for line in textwrap.wrap(" ".join(text.split()), width))


def found_in(df):
    return sorted((r.doc_id, r.license) for r in df.collect())


@pytest.mark.parametrize("name", ["MIT", "ISC", "Apache-2.0 header", "GPL-3.0 header", "MPL-2.0 header", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0"])
def test_wrapped_licences_in_long_documents(documents, name):
    text = licenses.TEMPLATES[name]
    inside = "\n".join([prose(0, 300), wrapped(text), prose(300, 300)])
    commented = "\n".join([prose(0, 50), wrapped(text, 60, " * "), prose(50, 200)])
    one_line = " ".join([prose(0, 300), *text.split(), prose(300, 300)])
    rows = [(1, inside), (2, commented), (3, one_line), (4, prose(0, 500))]
    # A line may be a notice of its own, and the second text as a whole be like a long licence.
    found = found_in(licenses.passages(documents(rows)))
    assert found in ([(1, name), (2, name), (3, name)], [(1, name), (3, name)])
    assert {(1, name), (2, name), (3, name)} <= set(found_in(licenses.scan_all(documents(rows))))


def test_passages_between_other_words(documents):
    bsd = licenses.TEMPLATES["BSD-3-Clause"].split()
    edited = " ".join(w for i, w in enumerate(bsd) if i % 20)
    rows = [
        (1, "See the file; it is Released under the MIT License. Thanks to all who helped with it."),
        (2, "\n".join(["Foo", prose(0, 100), wrapped(edited, 50), prose(200, 90)])),
        (3, "\n".join([wrapped(licenses.TEMPLATES["MIT"]), prose(0, 200), wrapped(licenses.TEMPLATES["ISC"]), prose(0, 200), wrapped(licenses.TEMPLATES["MIT"])])),
        (4, "Some text here.\nReleased under the MIT License.\nMore text."),
        (5, " ".join(licenses.TEMPLATES["MIT"].split()[:80]) + "\n" + prose(0, 100)),
    ]
    found = licenses.passages(documents(rows)).collect()
    assert sorted((r.doc_id, r.license) for r in found) == [
        (1, "MIT notice"), (2, "BSD-3-Clause"), (3, "ISC"), (3, "MIT"), (3, "MIT"),
    ]
    by_doc = {r.doc_id: r for r in found}
    assert (by_doc[1].unit, by_doc[1].dice, by_doc[1].n_bigrams) == (-6, 1.0, 4)
    assert all(r.dice >= 0.8 for r in found)


def test_passages_of_odd_tables(odd_documents, clashing, no_documents, documents):
    assert licenses.passages(odd_documents).collect() == []
    assert licenses.passages(clashing).collect() == []
    assert licenses.passages(no_documents).collect() == []
    assert licenses.passages(documents([(1, "x")]), {}).collect() == []


@pytest.mark.parametrize("gap", [0, 1, 3, 8, 30, 200])
def test_copies_are_told_apart(documents, gap):
    """Whole notices one after the other, with any number of other words in between."""
    between = [" ".join(f"gap{k}x{i}" for i in range(gap)) for k in range(4)]
    rows = []
    for i, name in enumerate(["MIT", "ISC", "MIT notice"]):
        text = " ".join(licenses.TEMPLATES[name].split())
        for copies in (1, 2, 4):
            # Long enough for no line or whole text to be like a notice.
            parts = [prose(0, 300)]
            for k in range(copies):
                parts += [text, between[k]]
            rows.append((10 * i + copies, " ".join([*parts, prose(300, 300)])))
    found = found_in(licenses.passages(documents(rows)))
    for i, name in enumerate(["MIT", "ISC", "MIT notice"]):
        for copies in (1, 2, 4):
            assert found.count((10 * i + copies, name)) == copies, (name, copies)


def plain_stretches(words, grams, least):
    """All pairs of first and last word whose distinct bigrams reach ``least``."""
    pairs_ = list(zip(words, words[1:]))
    out = []
    for i in range(len(pairs_)):
        seen = set()
        for j in range(i, len(pairs_)):
            seen.add(pairs_[j])
            if 2 * len(seen & grams) >= least * (len(seen) + len(grams)):
                out.append((i, j + 1))
    return out


def test_no_stretch_is_lost(documents):
    """Every stretch that reaches the least shares words with a passage that is reported.

    Copies have up to two words replaced and still reach the least by themselves.
    """
    rng = random.Random(9)
    words = [f"term{i}" for i in range(24)]
    template = " ".join(words)
    grams = set(zip(words, words[1:]))
    rows, total = [], 0
    for i in range(100):
        text = []
        for _ in range(rng.randint(0, 4)):
            copy = list(words)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = f"other{rng.randrange(9)}"
            text += copy + [f"w{rng.randrange(50)}" for _ in range(rng.choice([0, 1, 2, 5, 9, 40]))]
        rows.append((i, "start here " + " ".join(text)))
    got = {}
    for r in licenses.passages(documents(rows), {"one": template}, 0.8).collect():
        got.setdefault(r.doc_id, []).append((-1 - r.unit, r.n_bigrams))
    by_line = {r.doc_id for r in licenses.scan(documents(rows), {"one": template}, 0.8).collect()}
    for doc_id, text in rows:
        if doc_id in by_line:
            continue
        stretches = plain_stretches(text.split(), grams, 0.8)
        starts = sorted(got.get(doc_id, []))
        assert bool(stretches) == bool(starts), text
        # A passage has its distinct bigrams at least as places.
        for first, last in stretches:
            assert any(start <= last and first <= start + n for start, n in starts), (text, first, last, starts)
        total += len(starts)
    assert total > 60

"""Licence scan: Dice coefficients of word bigrams against licence templates.

``scan`` compares lines and whole texts, ``passages`` the stretches of words in between,
and ``scan_all`` is both.
"""

from __future__ import annotations

from collections.abc import Mapping
from math import ceil, floor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, let
from tidemark.llm.license_texts import FULL_TEXTS

LEAST_DICE = 0.8

# Notices and licence texts as their authors publish them.
TEMPLATES: dict[str, str] = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause notice": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause notice": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0 notice": "Released into the public domain under CC0 1.0.",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version. This program is distributed in the hope "
        "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
        "more details. You should have received a copy of the GNU General Public License along with "
        "this program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/."
    ),
} | FULL_TEXTS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normal_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; only A-Z change case."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, r"[^\p{L}\p{N}]+"), "")


def bigrams(words: Column) -> Column:
    """Hashes of the distinct pairs of neighbouring words."""
    return F.array_distinct(pairs(words))


def pairs(words: Column) -> Column:
    """Hashes of all pairs of neighbouring words, in their order."""

    def hashed(w: Column) -> Column:
        found = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + F.lit(1))))
        return F.slice(found, F.lit(1), F.greatest(F.size(w) - F.lit(1), F.lit(0)))

    return let(words, hashed)


def size_bounds(size: int, least: float) -> tuple[int, int]:
    """How many bigrams a text may have to reach ``least`` with a template of ``size`` bigrams.

    Dice is at most ``2 min / (a + b)``, so the sizes differ by a factor of at most
    ``(2 - least) / least``.
    """
    factor = (2 - least) / least
    return ceil(size / factor - 1e-9), floor(size * factor + 1e-9)


_KNOWN = "array<struct<name:string,low:int,high:int,grams:array<bigint>,cells:array<array<bigint>>>>"
# Bigrams of a template that are looked through to tell whether it holds one.
_CELL = 32


def _template_grams(spark: SparkSession, texts: Mapping[str, str]) -> list[tuple[str, list[int]]]:
    """The templates that have bigrams, by name."""
    table = spark.createDataFrame(sorted(texts.items()), "name string, text string")
    rows = table.select("name", bigrams(normal_words(F.col("text"))).alias("grams")).collect()
    return [(name, grams) for name, grams in sorted(map(tuple, rows)) if grams]


def _constant(numbers: list[int]) -> Column:
    return F.array_remove(F.split(F.lit(" ".join(map(str, numbers))), " "), "").cast("array<bigint>")


def _cells(grams: list[int]) -> list[list[int]]:
    """The bigrams dealt by their remainder, about ``_CELL`` to a cell."""
    cells: list[list[int]] = [[] for _ in range(-(-len(grams) // _CELL))]
    for gram in grams:
        cells[gram % len(cells)].append(gram)
    return cells


def _holds(template: Column, gram: Column) -> Column:
    """Whether a template has the bigram, by the one cell where it could be."""
    cells = template["cells"]
    return F.array_contains(F.get(cells, F.pmod(gram, F.size(cells)).cast("int")), gram)


def _templates(rows: list[tuple[str, list[int]]], least: float) -> Column:
    """The templates as one constant array: names, size bounds and bigrams."""
    constants = []
    for name, grams in rows:
        low, high = size_bounds(len(grams), least)
        constants.append(
            F.struct(
                F.lit(name).alias("name"),
                F.lit(low).alias("low"),
                F.lit(high).alias("high"),
                # One string is one literal, however long the text is.
                _constant(grams).alias("grams"),
                F.array(*map(_constant, _cells(grams))).alias("cells"),
            )
        )
    return F.array(*constants) if constants else F.array().cast(_KNOWN)


def _best(grams: Column, known: Column, least: float) -> Column:
    """``dice, name`` of the template most like ``grams``; NULL if none reaches ``least``."""
    n = F.size(grams)
    near = F.filter(known, lambda t: (n >= t["low"]) & (n <= t["high"]))

    def dice(t: Column) -> Column:
        both = F.size(F.array_intersect(grams, t["grams"])).cast("double")
        return F.struct(
            (F.lit(2.0) * both / (n + F.size(t["grams"]))).alias("dice"), t["name"].alias("name")
        )

    scores = F.filter(F.transform(near, dice), lambda s: s["dice"] >= F.lit(least))
    top = lambda found: F.filter(found, lambda s: s["dice"] == F.array_max(found)["dice"])
    return let(scores, lambda found: F.array_min(top(found)))


def scan(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST_DICE
) -> DataFrame:
    """Licences in ``docs``: ``doc_id, unit, license, dice, n_bigrams``, one row per unit that has one.

    Unit 0 is the whole text, unit ``i`` its ``i``-th line. Templates whose size bounds a
    unit's bigram count misses are not compared; of the others the one with the greatest
    Dice coefficient counts, of equals the first by name. The templates are a parameter,
    held as a constant of the plan, so nothing is shuffled.

    NULL, empty and one-word texts have no bigram and so no row; repeated rows give
    repeated rows; rows without an id keep a NULL id.
    """
    if not 0 < least <= 1:
        raise ValueError("the least Dice coefficient must lie in (0, 1]")
    known = _templates(_template_grams(docs.sparkSession, templates), least)
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), normal_words)

    def with_whole(words: Column) -> Column:
        # The words of a text are those of its lines. A text of one line is the line as well;
        # the line then stands for both.
        whole = F.when(F.size(words) > 1, F.flatten(words)).otherwise(F.array().cast("array<string>"))
        return F.concat(F.array(whole), words)

    units = id_and_text(docs).select("doc_id", F.posexplode(let(lines, with_whole)).alias("unit", "words"))
    counted = units.select("doc_id", "unit", bigrams(F.col("words")).alias("grams"))
    scored = counted.select(
        "doc_id", "unit", F.explode(F.array(let(F.col("grams"), lambda g: F.struct(
            _best(g, known, least).alias("best"), F.size(g).alias("n")
        )))).alias("found")
    )
    return scored.where(F.col("found.best").isNotNull()).select(
        "doc_id",
        F.col("unit").cast("bigint").alias("unit"),
        F.col("found.best.name").alias("license"),
        F.col("found.best.dice").alias("dice"),
        F.col("found.n").cast("bigint").alias("n_bigrams"),
    )


def _steps(grams: Column) -> Column:
    """``at, gram, before, after``: each place with the same bigram's last and next one."""
    marked = F.transform(grams, lambda g, i: F.struct(g.alias("gram"), i.alias("at")))

    def linked(held: Column) -> Column:
        def beside(x: Column, j: Column, none: int) -> Column:
            other = F.get(held, j)
            return F.when(other["gram"] == x["gram"], other["at"]).otherwise(F.lit(none))

        return F.transform(
            held,
            lambda x, j: F.struct(
                x["at"].alias("at"),
                x["gram"].alias("gram"),
                beside(x, j - F.lit(1), -1).alias("before"),
                beside(x, j + F.lit(1), 2**31 - 1).alias("after"),
            ),
        )

    return F.array_sort(let(F.array_sort(marked), linked))


def _stretches(steps: Column, template: Column, least: float) -> Column:
    """Stretches of ``steps`` that reach ``least`` with ``template``, from left to right.

    A stretch reaches it when ``(2 - least) * hits - least * others`` over its distinct
    bigrams is ``least`` times the template's size. A run ends where that sum falls to 0,
    so what lies before cannot help what follows; its greatest sum is where the stretch
    ends, and the greatest sum backwards from there is where it starts. Behind the end so far
    a second run counts all bigrams anew: another copy adds nothing to the first run, but once
    the second one reaches the least by itself, it ends the first and takes its place, and where
    the first falls to 0 it goes on as well. So copies are told apart whatever lies between them,
    if each reaches the least by itself. What a part of a copy has counted, a whole one close
    behind it does not count again, so a part may hide the whole one.
    """
    hit, other = F.lit(2.0 - least), F.lit(-float(least))
    size = F.size(template["grams"])
    enough = F.lit(float(least)) * size - F.lit(1e-6)
    span = "start:int,end:int"
    run = "struct<start:int,score:double,hits:int,best:double,end:int,most:int>"
    state = f"struct<main:{run},next:{run},found:array<struct<{span}>>>"

    def fresh(at: Column) -> Column:
        none = F.lit(0)
        return F.struct(
            at.alias("start"), F.lit(0.0).alias("score"), none.alias("hits"), F.lit(0.0).alias("best"),
            F.lit(-1).alias("end"), none.alias("most"),
        ).cast(run)

    def closed(found: Column, r: Column) -> Column:
        one = F.array(F.struct(r["start"].alias("start"), r["end"].alias("end")))
        return F.when(r["most"] >= template["low"], F.concat(found, one)).otherwise(found)

    def advanced(r: Column, x: Column, held: Column) -> Column:
        new = x["before"] < r["start"]
        score = r["score"] + F.when(new & held, hit).when(new, other).otherwise(F.lit(0.0))
        hits = r["hits"] + (new & held).cast("int")
        better = score > r["best"]
        return F.struct(
            r["start"].alias("start"), score.alias("score"), hits.alias("hits"),
            F.greatest(score, r["best"]).alias("best"),
            F.when(better, x["at"]).otherwise(r["end"]).alias("end"),
            F.when(better, hits).otherwise(r["most"]).alias("most"),
        ).cast(run)

    def forward(s: Column, x: Column) -> Column:
        after = fresh(x["at"] + F.lit(1))

        def both(held: Column) -> Column:
            pair = F.struct(advanced(s["main"], x, held).alias("main"), advanced(s["next"], x, held).alias("next"))
            return let(pair, moved)

        def moved(p: Column) -> Column:
            main, following = p["main"], p["next"]
            grown = (main["best"] > s["main"]["best"]) | (main["end"] < 0)
            following = F.when(grown | (following["score"] <= 0), after).otherwise(following)
            whole = ~grown & (following["best"] >= enough) & (following["most"] >= template["low"])
            ends = whole | (main["score"] <= 0)
            return F.struct(
                F.when(ends, following).otherwise(main).alias("main"),
                F.when(ends, after).otherwise(following).alias("next"),
                F.when(ends, closed(s["found"], main)).otherwise(s["found"]).alias("found"),
            ).cast(state)

        return let(_holds(template, x["gram"]), both)

    empty = F.array().cast(f"array<struct<{span}>>")
    zero = F.struct(fresh(F.lit(0)).alias("main"), fresh(F.lit(0)).alias("next"), empty.alias("found"))
    runs = F.aggregate(
        steps, zero.cast(state), forward, lambda s: closed(closed(s["found"], s["main"]), s["next"])
    )

    back_state = "struct<score:double,hits:int,n:int,best:double,start:int,most:int,size:int>"
    back_zero = F.struct(
        F.lit(0.0).alias("score"), F.lit(0).alias("hits"), F.lit(0).alias("n"), F.lit(0.0).alias("best"),
        F.lit(-1).alias("start"), F.lit(0).alias("most"), F.lit(0).alias("size"),
    ).cast(back_state)

    def backward(stretch: Column) -> Column:
        def step(s: Column, x: Column) -> Column:
            new = x["after"] > stretch["end"]
            is_hit = new & _holds(template, x["gram"])

            def after(held: Column) -> Column:
                score = s["score"] + F.when(held, hit).when(new, other).otherwise(F.lit(0.0))
                hits, n = s["hits"] + held.cast("int"), s["n"] + new.cast("int")
                better = score > s["best"]
                return F.struct(
                    score.alias("score"), hits.alias("hits"), n.alias("n"),
                    F.when(better, score).otherwise(s["best"]).alias("best"),
                    F.when(better, x["at"]).otherwise(s["start"]).alias("start"),
                    F.when(better, hits).otherwise(s["most"]).alias("most"),
                    F.when(better, n).otherwise(s["size"]).alias("size"),
                ).cast(back_state)

            return let(is_hit, after)

        length = stretch["end"] - stretch["start"] + F.lit(1)
        places = F.slice(steps, stretch["start"] + F.lit(1), length)
        return F.aggregate(F.reverse(places), back_zero, step, lambda s: F.struct(
            (-s["most"]).alias("shared"),
            (F.lit(-2.0) * s["most"] / (s["size"] + size)).alias("dice"),
            template["name"].alias("name"),
            s["start"].alias("start"),
            stretch["end"].alias("end"),
            s["size"].alias("n"),
        ))

    return F.filter(F.transform(runs, backward), lambda w: -w["dice"] >= F.lit(least))


def _apart(found: Column) -> Column:
    """Of stretches that share words, those with more bigrams of their template stay."""
    kind = "array<struct<shared:int,dice:double,name:string,start:int,end:int,n:int>>"

    def add(kept: Column, w: Column) -> Column:
        clash = F.exists(kept, lambda k: (k["start"] <= w["end"]) & (w["start"] <= k["end"]))
        return F.when(clash, kept).otherwise(F.concat(kept, F.array(w))).cast(kind)

    return F.aggregate(F.array_sort(found), F.array().cast(kind), add)


def _licensed_lines(text: Column, known: Column, least: float) -> Column:
    """``first, last, name`` of the lines that ``scan`` reports, in words of the text."""
    kind = "struct<words:int,found:array<struct<first:int,last:int,name:string>>>"
    zero = F.struct(F.lit(0).alias("words"), F.array().alias("found")).cast(kind)

    def add(s: Column, line: Column) -> Column:
        def told(w: Column) -> Column:
            def joined(best: Column) -> Column:
                end = s["words"] + F.size(w)
                one = F.array(F.struct(
                    s["words"].alias("first"), (end - F.lit(1)).alias("last"), best["name"].alias("name")
                ))
                found = F.when(best.isNull(), s["found"]).otherwise(F.concat(s["found"], one))
                return F.struct(end.alias("words"), found.alias("found")).cast(kind)

            return let(let(bigrams(w), lambda g: _best(g, known, least)), joined)

        return let(normal_words(line), told)

    return F.aggregate(F.split(text, "\n"), zero, add, lambda s: s["found"])


def passages(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST_DICE
) -> DataFrame:
    """Licences that are neither a line nor a whole text, in the columns of ``scan``.

    A passage is any stretch of neighbouring words, over line ends or inside a line; its
    unit is ``-w`` if it begins at the text's ``w``-th word. A text can only hold one if it
    holds the least number of a template's bigrams that a match shares, so few texts are
    searched. Of passages that share words, the one that shares more bigrams with its
    template stays; one that a line or the whole text reports already is left out.
    """
    if not 0 < least <= 1:
        raise ValueError("the least Dice coefficient must lie in (0, 1]")
    rows = _template_grams(docs.sparkSession, templates)
    known = _templates(rows, least)
    every = ",".join(f"{g}L" for g in sorted({g for _, grams in rows for g in grams}))
    texts = id_and_text(docs).select("doc_id", "text", pairs(normal_words(F.col("text"))).alias("grams"))
    shared = F.expr(f"array_distinct(filter(grams, g -> g IN ({every or 'NULL'})))")

    def near(held: Column) -> Column:
        enough = lambda t: (F.size(held) >= t["low"]) & (
            F.size(F.array_intersect(t["grams"], held)) >= t["low"]
        )
        return F.filter(known, enough)

    # Exploding an array of one keeps the plan from computing a column again where it is used.
    candidates = texts.select(
        "doc_id", "text", F.explode(F.array(F.struct("grams", let(shared, near).alias("near")))).alias("c")
    ).where(F.size("c.near") > 0)

    def searched(steps: Column) -> Column:
        return _apart(F.flatten(F.transform(F.col("c.near"), lambda t: _stretches(steps, t, least))))

    is_whole = F.size(F.split("text", "\n")) > 1
    whole = let(F.array_distinct("c.grams"), lambda g: _best(g, known, least))
    told = candidates.select(
        "doc_id",
        F.explode(F.array(F.struct(
            let(_steps(F.col("c.grams")), searched).alias("found"),
            _licensed_lines(F.col("text"), known, least).alias("lines"),
            F.when(is_whole, whole["name"]).alias("whole"),
        ))).alias("t"),
    )
    by_line = F.exists(
        "t.lines",
        lambda x: (x["name"] == F.col("w.name"))
        & (x["first"] <= F.col("w.end") + F.lit(1))
        & (F.col("w.start") <= x["last"]),
    )
    left = told.select("doc_id", "t", F.explode("t.found").alias("w")).where(
        ~by_line & ~F.col("t.whole").eqNullSafe(F.col("w.name"))
    )
    return left.select(
        "doc_id",
        (F.lit(-1) - F.col("w.start")).cast("bigint").alias("unit"),
        F.col("w.name").alias("license"),
        (-F.col("w.dice")).alias("dice"),
        F.col("w.n").cast("bigint").alias("n_bigrams"),
    )


def scan_all(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST_DICE
) -> DataFrame:
    """``scan`` and ``passages`` together."""
    return scan(docs, templates, least).unionByName(passages(docs, templates, least))

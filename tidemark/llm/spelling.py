"""Spelling variants: exact neighbours at one edit, found as pairs of trie nodes.

Every word is a path down a trie of the words and up a trie of the reversed words. With the
nodes of both numbered, the pair (node before a place, node behind it) stands for all that a
word has around that place. Two words that differ in one replaced letter share a pair across
the skipped letter; a word and one with a letter more share the pair at the inserted place.
Equal pairs are equal strings, so nothing has to be verified. A pair holds at most one word
per letter of the alphabet and one word without it, so its neighbours are counted and the most
frequent is chosen inside an aggregate: no list of word pairs is made.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, map_batches, ship
from tidemark.operators.keys import dense_keys
from tidemark.sources.scratch import pin

LEAST_LETTERS = 5
LEAST_COUNT = 3
EDITED_ONE_IN = 97
FORM_TIMES = 2
# Words that are numbered together in one task.
BLOCK = 65_536
# What a task counts before it hands its counts on: characters of distinct words.
_HELD = 4_000_000

_RUN = re.compile("[a-zÀ-ÿ]+")
_COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _lowered(text: str) -> str:
    """``text`` with A to Z in lower case and nothing else changed."""
    return text.encode().lower().decode()


def edited(doc_id: int | None, run: str) -> str:
    """``run`` of a document, one of ``EDITED_ONE_IN`` without one of its letters."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % EDITED_ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()
    size = 0
    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in Counter(_RUN.findall(_lowered(text))).items():
                if len(run) < LEAST_LETTERS:
                    continue
                if zlib.crc32(run.encode(), start) % EDITED_ONE_IN == 0:
                    run = edited(doc_id, run)
                    if len(run) < LEAST_LETTERS:
                        continue
                if run not in held:
                    size += len(run)
                held[run] += n
            if size > _HELD:
                yield from batches_of(held.items(), _COUNTED)
                held, size = Counter(), 0
    yield from batches_of(held.items(), _COUNTED)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all documents, edited words as what they became; NULL texts hold none."""
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).where(F.col("text").isNotNull())
    parts = map_batches(texts, _count, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _shared(a: str, b: str) -> int:
    """Letters that both begin with."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


_PATHS = pa.schema(
    [
        ("id", pa.int64()),
        ("block", pa.int64()),
        ("path", pa.list_(pa.int64())),
        ("first", pa.string()),
        ("last", pa.string()),
        ("nodes", pa.int64()),
    ]
)


def _block_paths(table: pa.Table) -> pa.Table:
    """Numbers the nodes of one block's trie from 0, in the order in which its words make them.

    The last row of a block also carries what the next block needs to know.
    """
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("rank", "block", "id", "key")), strict=True))
    out, path, before, nodes = [], [], "", 0
    for _, block, word_id, key in rows:
        kept = _shared(before, key)
        path = path[:kept] + list(range(nodes, nodes + len(key) - kept))
        nodes += len(key) - kept
        before = key
        out.append((word_id, block, path, None, None, None))
    out[-1] = (*out[-1][:3], rows[0][3], before, nodes)
    return pa.Table.from_batches(batches_of(iter(out), _PATHS), _PATHS)


def trie_paths(words: DataFrame, key: Column) -> DataFrame:
    """``id, path``: for every word of ``words (id, word)`` the numbers of its trie nodes.

    ``path[i]`` is the node of the first ``i + 1`` letters of ``key``; equal prefixes have
    equal numbers, others do not, over the whole table. Nodes are numbered from 1; the root,
    0, is in no path. Keys are distinct and sorted; each ``BLOCK`` of them is numbered by
    itself. Blocks then only have to agree on the nodes that the first word of one shares with
    the last word of the one before it, for which one row per block reaches the driver.
    """
    spark = words.sparkSession
    ship(spark)
    ranked = dense_keys(words.select("id", key.alias("key")), ["key"], "rank")
    blocks = ranked.withColumn("block", F.floor((F.col("rank") - 1) / BLOCK).cast("bigint"))
    schema = "id bigint, block bigint, path array<bigint>, first string, last string, nodes bigint"
    local = pin(blocks.groupBy("block").applyInArrow(_block_paths, schema), "paths")
    ends = local.where(F.col("nodes").isNotNull()).orderBy("block").collect()
    maps, base, before, carried = [], 1, "", []
    for end in ends:
        shared = _shared(before, end.first)
        carry = carried[:shared]
        maps.append((end.block, base, carry))
        carried = [carry[x] if x < shared else base + x - shared for x in end.path]
        base += end.nodes - shared
        before = end.last
    mapped = spark.createDataFrame(maps, "block bigint, base bigint, carry array<bigint>")
    size = F.size("carry")
    return local.join(mapped, "block").select(
        "id",
        F.transform(
            "path", lambda x: F.when(x < size, F.get("carry", x)).otherwise(F.col("base") + x - size)
        ).alias("path"),
    )


def _entries(words: DataFrame) -> DataFrame:
    """A row per word and place: ``before, behind, id, n, skips, opens``.

    ``skips`` rows leave out the letter at the place, the others lie between two letters.
    ``opens`` marks a letter unlike the one before it: leaving out any of a run of equal
    letters gives the same word, and only the first of them counts.
    """
    down = trie_paths(words, F.col("word")).withColumnRenamed("path", "down")
    up = trie_paths(words, F.reverse("word")).withColumnRenamed("path", "up")
    # Node 0 for the empty prefix and the empty suffix.
    root = F.array(F.lit(0).cast("bigint"))
    both = (
        words.join(down, "id")
        .join(up, "id")
        .select(
            "id",
            "n",
            F.split("word", "").alias("letters"),
            F.concat(root, "down").alias("down"),
            F.concat(root, "up").alias("up"),
        )
    )
    length = F.size("letters")

    def at(i: Column, skips: bool) -> Column:
        opens = (i == 0) | (F.get("letters", i) != F.get("letters", i - 1))
        return F.struct(
            F.get("down", i).alias("before"),
            F.get("up", length - i - int(skips)).alias("behind"),
            F.lit(skips).alias("skips"),
            (opens if skips else F.lit(False)).alias("opens"),
        )

    places = F.concat(
        F.transform(F.sequence(F.lit(0), length - 1), lambda i: at(i, True)),
        F.transform(F.sequence(F.lit(0), length), lambda i: at(i, False)),
    )
    return both.select("id", "n", F.inline(places))


def neighbours(words: DataFrame) -> DataFrame:
    """``id, n_near, best_n, best_id`` of the words of ``words (id, word, n)`` that have any.

    ``id`` is the word's rank in code-point order, so the best of equally frequent ones is the
    one with the least id.
    """
    member = F.struct("n", (-F.col("id")).alias("back"), "opens")
    pairs = (
        _entries(words)
        .groupBy("before", "behind")
        .agg(
            # One word per letter of the alphabet at most.
            F.collect_list(F.when(F.col("skips"), member)).alias("with_letter"),
            F.max(F.when(~F.col("skips"), F.struct("n", (-F.col("id")).alias("back")))).alias("without"),
        )
        .where((F.size("with_letter") > 1) | F.col("without").isNotNull())
        .where(F.size("with_letter") > 0)
    )
    bare = "array<struct<n:bigint,back:bigint>>"
    ranked = F.reverse(F.array_sort(F.transform("with_letter", lambda m: F.struct(m["n"], m["back"])).cast(bare)))
    openers = F.filter("with_letter", lambda m: m["opens"])
    best_opener = F.array_max(F.transform(openers, lambda m: F.struct(m["n"], m["back"])).cast(bare))
    pairs = pairs.select(
        "with_letter",
        "without",
        F.get(ranked, F.lit(0)).alias("top"),
        F.get(ranked, F.lit(1)).alias("next"),
        F.size("with_letter").alias("members"),
        F.size(openers).alias("openers"),
        best_opener.alias("best_opener"),
    )

    def found(m: Column) -> Column:
        other = F.when(m["back"] == F.col("top.back"), F.col("next")).otherwise(F.col("top"))
        shorter = F.when(m["opens"], F.col("without"))
        return F.struct(
            (-m["back"]).alias("id"),
            (F.col("members") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0)).cast("bigint").alias("near"),
            F.greatest(other, shorter).alias("best"),
        )

    longer = F.struct(
        (-F.col("without.back")).alias("id"),
        F.col("openers").cast("bigint").alias("near"),
        F.col("best_opener").alias("best"),
    )
    each = F.concat(
        F.transform("with_letter", found),
        F.when(F.col("without").isNotNull(), F.array(longer)).otherwise(F.array().cast(
            "array<struct<id:bigint,near:bigint,best:struct<n:bigint,back:bigint>>>"
        )),
    )
    return (
        pairs.select(F.inline(each))
        .where(F.col("near") > 0)
        .groupBy("id")
        .agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
        .select("id", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.back")).alias("best_id"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``id, root`` of every ``id, form``: the last of the forms that follow one another.

    Each form is at least twice as frequent, so a chain has less than 64 links and six rounds
    that double the reach of every link end any; each is written out.
    """
    links = pin(forms, "forms")
    while True:
        onward = links.select(F.col("id").alias("__id"), F.col("form").alias("__form"))
        longer = pin(
            links.join(onward, links["form"] == onward["__id"], "left").select(
                "id",
                F.coalesce("__form", "form").alias("form"),
                F.col("__form").isNotNull().alias("moved"),
            ),
            "forms",
        )
        links = longer.select("id", "form")
        if longer.where("moved").isEmpty():
            return links.withColumnRenamed("form", "root")


def group_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the documents.

    Words are runs of Latin letters in lower case with at least ``LEAST_LETTERS`` letters that
    occur at least ``LEAST_COUNT`` times. ``form`` is the most frequent word at one edit, the
    first in code-point order of equally frequent ones, if it is ``FORM_TIMES`` as frequent;
    ``root`` is where the forms end, the word itself without one. NULL and empty texts hold
    no words; a NULL id counts as an empty one where words are edited; repeated rows count
    each time; empty tables give no rows; extra columns are ignored.
    """
    counted = word_counts(docs).where(F.char_length("word") >= LEAST_LETTERS)
    words = pin(dense_keys(counted, ["word"], "id"), "words")
    judged = pin(
        words.select("id", "n")
        .join(neighbours(words), "id", "left")
        .withColumn("form", F.when(F.col("best_n") >= F.col("n") * FORM_TIMES, F.col("best_id"))),
        "near",
    )
    roots = _roots(judged.where(F.col("form").isNotNull()).select("id", "form"))
    spelled = words.select(F.col("id").alias("form"), F.col("word").alias("form_word"))
    ended = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    linked = (
        judged.where(F.col("form").isNotNull())
        .select("id", "form", F.col("best_n").alias("form_n"))
        .join(roots, "id")
        .join(spelled, "form")
        .join(ended, "root")
        .select("id", "form_word", "root_word", "form_n")
    )
    near = judged.select("id", F.coalesce("n_near", F.lit(0)).alias("n_near"))
    return (
        words.join(near, "id")
        .join(linked, "id", "left")
        .select(
            "word",
            F.col("form_word").alias("form"),
            F.coalesce("root_word", "word").alias("root"),
            "n",
            "n_near",
            "form_n",
        )
    )

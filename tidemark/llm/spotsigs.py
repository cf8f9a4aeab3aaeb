"""Document fingerprints from spot signatures.

Wherever a very common word stands, the next few content words form a chain. Chains
follow the running text, not its navigation or templates, and an edit changes only the
chains that cross it. A fingerprint is the sorted bag of its chains' hashes.

Other languages, code, tables and lists have few such words or none. Where ``SPARSE``
content words follow one another without one, the word pair with the least hash of each
window of that many pairs begins a chain as well, so that every text has chains all over
and equal passages choose equal words wherever they stand.

Two bags whose sizes differ by more than a factor cannot be alike by more than that
factor, so ``likeness`` with a least value does not count such pairs through. The
registered query needs every value and asks for none; nothing here compares documents
other than neighbours and edits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, id_and_text, map_batches, partitions

# The commonest function words of four languages.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was were with "
    "das dem den der des die ein eine im ist mit nicht sich sie und von zu "
    "au aux ce dans des du elle est et il la le les ne pas pour que qui se sur un une "
    "con de del el en es esta las lo los no para por se su una y"
).split()

CHAIN = 2  # content words after an anchor
SPARSE = 8  # content words in a row without an anchor, from which on they have their own
# Letters of scripts without blanks between words, each a word of its own: Thai to Myanmar,
# Khmer, kana, Han and their extensions.
_UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\U00020000-\U0003ffff]"
)
_LONG_TOKEN = 40  # characters from which on a token is no word
_RUNS = re.compile(r"[^\W_]+")
_HASH_BYTES = 6
_CACHED_WORDS = 400_000
_START = np.uint64(0x27D4EB2F165667C5)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class _WordCodes(dict):
    """Hashes of words without the marks around them; odd for anchors, 0 for no word."""

    def __missing__(self, token: str) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        word = token
        while word and not word[0].isalnum():
            word = word[1:]
        while word and not word[-1].isalnum():
            word = word[:-1]
        value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) | 1
        value = (value if word in _ANCHOR_SET else value ^ 1) if word else 0
        self[token] = value
        return value


_ANCHOR_SET = frozenset(ANCHORS)
_codes = _WordCodes()


def _tokens(text: str) -> list[str]:
    """Lower-case tokens between white space.

    Letters of unspaced scripts stand alone. A token longer than any word is cut at its
    marks, and what is still as long into its characters.
    """
    text = text.lower()
    if not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \g<0> ", text)
    tokens = text.split()
    if not tokens or max(map(len, tokens)) <= _LONG_TOKEN:
        return tokens
    out: list[str] = []
    for token in tokens:
        if len(token) <= _LONG_TOKEN:
            out.append(token)
            continue
        for run in _RUNS.findall(token):
            out.extend(run if len(run) > _LONG_TOKEN else (run,))
    return out


def _own_anchors(content: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places of the content words that begin a chain where no anchor stands near.

    ``starts`` says how many content words come before each anchor. Within a run of
    content words between anchors, each window of ``SPARSE`` neighbouring pairs chooses its
    least one; a run with fewer pairs has none.
    """
    n = len(content) - 1
    if n < SPARSE:
        return np.empty(0, np.int64)
    edges = np.concatenate(([0], starts, [len(content)]))
    if int(np.diff(edges).max()) <= SPARSE:
        return np.empty(0, np.int64)
    mixed = content[:-1] * _FACTORS[0] ^ content[1:] * _FACTORS[1]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _FACTORS[2]
    mixed ^= mixed >> np.uint64(29)
    windows = np.lib.stride_tricks.sliding_window_view(mixed, SPARSE)
    # Windows that cross an anchor do not count: between their words stands one already.
    cut = np.zeros(len(content) + 1, np.int64)
    cut[starts] = 1
    crossed = np.cumsum(cut)
    first = np.arange(len(windows))
    free = first[crossed[first + SPARSE] == crossed[first]]
    return np.unique(free + windows[free].argmin(axis=1))


def signatures(text: str | None, chain: int = CHAIN) -> np.ndarray:
    """The sorted 48-bit hashes of all chains of ``text``, repeats included.

    The start of the text counts as an anchor, and where anchors are sparse, chosen content
    words do (see above). A text with too few content words for any
    chain has one signature, of all its words or, without a word, of its characters; an
    empty text and NULL have none.
    """
    if not text:
        return np.empty(0, np.uint64)
    tokens = _tokens(text)
    codes = np.fromiter(map(_codes.__getitem__, tokens), np.uint64, len(tokens))
    codes = codes[codes != 0]
    anchor = (codes & np.uint64(1)).astype(bool)
    content = codes[~anchor]
    room = len(content) - chain + 1
    if room < 1:
        whole = codes.tobytes() if len(codes) else text.encode("utf-8", "surrogatepass")
        lone = np.array([xxhash.xxh64_intdigest(whole)], np.uint64)
        return lone >> np.uint64(64 - 8 * _HASH_BYTES)
    # How many content words come before each anchor is where its chain begins.
    starts = np.concatenate(([0], np.cumsum(~anchor)[anchor]))
    own = _own_anchors(content, starts)
    total = np.concatenate(([_START], codes[anchor], content[own])) * _FACTORS[0]
    starts = np.concatenate((starts, own + 1))
    fits = starts < room
    starts, total = starts[fits], total[fits]
    for i in range(chain):
        total = (total ^ (total >> np.uint64(31))) * _FACTORS[1] + content[starts + i] * _FACTORS[2]
    total = (total ^ (total >> np.uint64(29))) * _FACTORS[0]
    return np.sort(total >> np.uint64(64 - 8 * _HASH_BYTES))


def as_text(bag: np.ndarray) -> str:
    """Twelve lower-case hex digits per signature."""
    octets = bag.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - _HASH_BYTES :]
    return octets.tobytes().hex()


def size_class(size: int, least: float) -> int:
    """Classes of sizes: bags alike by ``least`` or more are in one class or in two that touch."""
    return floor(log(size) / -log(least)) if size else -1


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard coefficient of two sorted bags; 0 once it is known to be below ``least``.

    Two empty bags are alike by 1.
    """
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if not small or small < least * large:
        return 0.0
    if 0 < least < 1 and abs(size_class(small, least) - size_class(large, least)) > 1:
        return 0.0
    if small == large and np.array_equal(a, b):
        return 1.0
    at_a, at_b = _places(a), _places(b)
    keys_a, keys_b = a[at_a[:-1]], b[at_b[:-1]]
    _, i, j = np.intersect1d(keys_a, keys_b, assume_unique=True, return_indices=True)
    both = int(np.minimum(np.diff(at_a)[i], np.diff(at_b)[j]).sum())
    found = both / (len(a) + len(b) - both)
    return found if found >= least else 0.0


def _places(bag: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.flatnonzero(bag[1:] != bag[:-1]) + 1, [len(bag)]))


def fingerprints(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """``doc_id, n_signatures, fingerprint``, one row per row of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [signatures(t, chain) for t in batch.column(1).to_pylist()]
            sizes = pa.array([len(b) for b in bags], pa.int64())
            texts = pa.array([as_text(b) for b in bags], pa.string())
            names = ["doc_id", "n_signatures", "fingerprint"]
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, texts], names)

    schema = "doc_id bigint, n_signatures bigint, fingerprint string"
    return map_batches(id_and_text(docs), work, schema)


def _place(value: Column, bounds: list[int]) -> Column:
    """How many of the rising ``bounds`` are less than ``value``, by halving."""
    if not bounds:
        return F.lit(0)
    table = F.array(*map(F.lit, bounds)).cast("array<bigint>")
    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.shiftright(low + high, 1)
        open_ = low < high
        less = open_ & (F.get(table, middle) < value)
        return F.struct(
            F.when(less, middle + F.lit(1)).otherwise(low).alias("low"),
            F.when(open_ & ~less, middle).otherwise(high).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    found = F.aggregate(steps, start, halve, lambda s: s["low"])
    return F.when(value.isNull(), F.lit(0)).otherwise(found)


def _with_successors(docs: DataFrame) -> DataFrame:
    """Rows dealt to ranges of ids, each range sorted and followed by the row that comes next.

    The ranges hold about as many rows each. Their bounds and least ids, two numbers per
    range, come from the ids alone; the first row of a range is sent to the range before
    it as well, and the very first one to the last.
    """
    rows = id_and_text(docs)
    count = partitions(docs.sparkSession)
    shares = [i / count for i in range(1, count)]
    asked = F.percentile_approx("doc_id", shares, 10_000) if shares else F.array()
    bounds = rows.agg(asked.alias("bounds")).first().bounds
    placed = rows.withColumn("range", _place(F.col("doc_id"), sorted(set(bounds or []))))
    firsts = placed.groupBy("range").agg(F.min(F.struct("doc_id")).alias("first")).collect()
    firsts = [(r["range"], r["first"].doc_id) for r in sorted(firsts, key=lambda r: r["range"])]
    before = {r: firsts[i - 1][0] for i, (r, _) in enumerate(firsts)}
    table = placed.sparkSession.createDataFrame(
        [(r, first, before[r]) for r, first in firsts], "range int, first bigint, target int"
    )
    own = placed.select(F.col("range").alias("target"), F.lit(0).alias("guest"), "doc_id", "text")
    ahead = F.col("doc_id").eqNullSafe(F.col("first"))
    guests = placed.join(F.broadcast(table), "range").where(ahead).select(
        "target", F.lit(1).alias("guest"), "doc_id", "text"
    )
    dealt = own.unionByName(guests).repartitionById(count, F.col("target"))
    return dealt.sortWithinPartitions("target", "guest", "doc_id", "text")


def edited(text: str, following: str) -> str:
    """``text`` with its second half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def against_edits(docs: DataFrame, chain: int = CHAIN, least: float = 0.0) -> DataFrame:
    """Each document's fingerprint next to its edited text's and the next document's.

    Documents follow one another by ``doc_id``, the first after the last; NULL ids come
    first and rows of one id by their texts. NULL texts are empty. A table of one row is
    followed by itself. Likenesses below ``least`` are 0.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_chars", pa.int64()),
            ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()),
            ("near_next", pa.float64()),
            ("n_signatures", pa.int64()),
        ]
    )

    def row(held: tuple, following: str, next_bag: np.ndarray) -> tuple:
        doc_id, text, bag = held
        changed = edited(text, following)
        other = signatures(changed, chain)
        return (
            doc_id,
            len(text),
            hashlib.sha256(changed.encode()).hexdigest(),
            as_text(bag),
            as_text(other),
            likeness(bag, other, least),
            likeness(bag, next_bag, least),
            len(bag),
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: tuple | None = None
        for batch in batches:
            _, guests, ids, texts = (c.to_pylist() for c in batch.columns)
            for guest, doc_id, text in zip(guests, ids, texts, strict=True):
                if guest and held is None:
                    return
                text = text or ""
                bag = signatures(text, chain)
                if held is not None:
                    yield row(held, text, bag)
                held = None if guest else (doc_id, text, bag)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(rows(batches), schema, 1024)

    spark_schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, n_signatures bigint"
    )
    return map_batches(_with_successors(docs), work, spark_schema)

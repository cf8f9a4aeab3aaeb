"""Language-model scores of documents by context-tree weighting over the whole corpus.

Nothing is kept from the corpus but what a document asks for, and all of that: each task cuts
its documents into chunks and writes, per chunk, the distinct byte runs (context and byte) and
words with their training counts. Counts of equal runs meet by a hash, whatever chunk they are
from; the context tree is mixed from them tier by tier, on groups that hold at most 2**24
runs whatever the corpus; the log probabilities go back with their runs to the chunks that asked,
where the documents are added up. A chunk is read part by part, before and after, so that a task
holds the positions of one part only, besides the distinct runs of its chunk. Every step is a
shuffle of narrow, evenly dealt rows, so the model may grow with the corpus and is never whole
in any place.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import context_tree as tree
from tidemark.llm.byte_grams import END, LEAD, ByteGrams
from tidemark.llm.common import map_batches, partitions
from tidemark.sources.scratch import new_folder, pin

DEPTH = 5  # bytes of context
# From which depth to which each tier of the tree goes, in one group per context of the latter.
TIERS = ((5, 3), (3, 1), (1, 0))
CHUNK_BYTES = 24 << 20  # of text whose runs and words are asked for together
PART_BYTES = 2 << 20  # of it that is looked at at once
BUCKET_BYTES = 32 << 20  # of text per bucket of runs and words, between the two numbers below
MOST_BUCKETS = 16_384
ONE_IN, HELD_OUT = 7, 2
_GROUP_ROWS = 1 << 18  # rows of small groups that are mixed at once
# A chunk's number is its task's and, in this many bits, its place in it.
_TASK_BITS = 32
_MADE = (1 << _TASK_BITS) - 1

# Pieces are compressed already and large: a writer that looks at its buffers only every 100
# rows, and then compresses them once more, holds several times what it writes.
_LARGE_ROWS = {
    "compression": "none",
    "parquet.block.size": 4 << 20,
    "parquet.page.size.row.check.min": 1,
    "parquet.enable.dictionary": "false",
}

_PIECES = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("more", T.BinaryType()),
    ]
)
_ARROW = {T.StringType: pa.string(), T.LongType: pa.int64(), T.IntegerType: pa.int32()}


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = _ARROW | {T.BinaryType: pa.binary(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_()}
    return pa.schema([(f.name, kinds[type(f.dataType)]) for f in schema])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _pack(values: bytes | np.ndarray) -> bytes:
    raw = values if isinstance(values, bytes) else values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(body: bytes, dtype: str | None = None) -> bytes | np.ndarray:
    size = int.from_bytes(body[:8], "little")
    raw = pa.decompress(body[8:], size, codec="zstd", asbytes=True)
    return raw if dtype is None else np.frombuffer(raw, dtype)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(body: bytes) -> np.ndarray:
    return np.cumsum(_unpack(body, "<u8"), dtype=np.uint64)


def _dealt(of: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """The places that hold each bucket that occurs, in order."""
    order = np.argsort(of, kind="stable")
    sizes = np.bincount(of, minlength=buckets)
    ends = np.cumsum(sizes)
    for bucket in np.flatnonzero(sizes).tolist():
        yield bucket, order[ends[bucket] - sizes[bucket] : ends[bucket]]


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the keys of each bucket that has any, in the order of the keys."""
    mixed = keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
    return _dealt((mixed % np.uint64(buckets)).astype(np.int64), buckets)


def _turned(keys: np.ndarray) -> np.ndarray:
    """From text order to latest byte first, or back; the byte that follows stays last."""
    out = keys & np.uint64(255)
    for i in range(DEPTH):
        byte = keys >> np.uint64(8 * (i + 1)) & np.uint64(255)
        out = out | byte << np.uint64(8 * (DEPTH - i))
    return out


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of sorted arrays, not all of them empty, and the sums of their counts."""
    whole = np.concatenate(keys)
    order = np.argsort(whole, kind="stable")
    whole = whole[order]
    first = np.flatnonzero(np.concatenate(([True], whole[1:] != whole[:-1])))
    return whole[first], np.add.reduceat(np.concatenate(counts)[order], first)


_BREAKS = np.zeros(256, bool)
_BREAKS[[*b" \t\n\x0b\f\r", LEAD, END]] = True


class _Part:
    """The texts of a part in one line of bytes: their byte runs and their words."""

    def __init__(self, texts: list[bytes]):
        lead, end = bytes([LEAD]) * DEPTH, bytes([END])
        self.data = np.frombuffer(b"".join(lead + t + end for t in texts), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + DEPTH + 1
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes

    def words(self) -> tuple[np.ndarray, np.ndarray, pa.LargeBinaryArray]:
        """The first word of each text and one past the last, which word each is, and the words."""
        letters = ~_BREAKS[self.data]
        # The line begins and ends with breaks.
        edges = np.flatnonzero(letters[1:] != letters[:-1]) + 1
        begins, stops = edges[::2], edges[1::2]
        offsets = np.concatenate(([0], np.cumsum(stops - begins)))
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(begins),
            [None, pa.py_buffer(offsets.astype("<i8")), pa.py_buffer(self.data[letters])],
        ).dictionary_encode()
        first = np.searchsorted(begins, np.append(self.starts, len(self.data)))
        return first, words.indices.to_numpy(), words.dictionary

    def grams(self) -> tuple[ByteGrams, np.ndarray]:
        """The byte runs, and which of them lie within a text."""
        grams = ByteGrams(self.data, DEPTH + 1)
        return grams, np.flatnonzero(grams.keys & np.uint64(255) != LEAD)


def _word_buckets(words: list[bytes], buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the words of each bucket that has any, in the order of the words."""
    return _dealt(np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets, buckets)


class _Asked:
    """The distinct byte runs and words of a chunk's parts, with their training counts."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.key_counts: list[np.ndarray] = []
        self.words: list[pa.LargeBinaryArray] = []
        self.word_counts: list[np.ndarray] = []

    def add(self, part: _Part, teachers: int) -> None:
        """``part`` begins with the documents that teach."""
        first, of, words = part.words()
        self.words.append(words)
        self.word_counts.append(np.bincount(of[: first[teachers]], minlength=len(words)))
        grams, own = part.grams()
        taught = int(part.starts[teachers]) if teachers < len(part.starts) else len(part.data)
        counts = np.bincount(grams.ids[: max(taught - DEPTH, 0)], minlength=len(grams.keys))
        self.keys.append(grams.keys[own])
        self.key_counts.append(counts[own])
        if sum(map(len, self.keys[1:])) > 1 << 21:
            keys, counts = _summed(self.keys, self.key_counts)
            self.keys, self.key_counts = [keys], [counts]

    def rows(self, number: int, buckets: int) -> Iterator[pa.RecordBatch]:
        schema = _arrow(_PIECES)
        encoded = pa.chunked_array(self.words).combine_chunks().dictionary_encode()
        words = encoded.dictionary.to_pylist()
        # Counts are whole numbers far below 2**53.
        counts = np.bincount(encoded.indices.to_numpy(), np.concatenate(self.word_counts), len(words)).astype("<i8")
        del encoded
        for bucket, at in _word_buckets(words, buckets):
            own = _pack(b" ".join([words[i] for i in at.tolist()]))
            yield _batch([("word", number, bucket, len(at), own, _pack(counts[at]))], schema)
        del words
        keys, counts = _summed(self.keys, self.key_counts)
        for bucket, at in _by_bucket(keys, buckets):
            row = ("gram", number, bucket, len(at), _pack_sorted(keys[at]), _pack(counts[at].astype("<i8")))
            yield _batch([row], schema)


def _gather(buckets: int):
    """Chunks of documents in parts, and per bucket what they ask for and teach."""
    schema = _arrow(_PIECES)

    def part(number: int, docs: list[tuple], asked: _Asked) -> pa.RecordBatch:
        # Documents that teach come first, so that their positions are one stretch.
        docs.sort(key=lambda d: d[1])
        texts = [d[2] for d in docs]
        teachers = sum(not d[1] for d in docs)
        asked.add(_Part(texts), teachers)
        meta = [(d[0] is not None, d[0] or 0, d[1], len(d[2])) for d in docs]
        row = ("text", number, 0, teachers, _pack(b"".join(texts)), _pack(np.array(meta, "<i8")))
        return _batch([row], schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _TASK_BITS
        held: list[tuple] = []
        asked = _Asked()
        size = whole = 0
        for batch in batches:
            for doc_id, out, text in zip(*batch.columns, strict=True):
                low = (text.as_py() or "").encode().lower()
                held.append((doc_id.as_py(), out.as_py(), low))
                size += len(low) + DEPTH + 1
                if size >= PART_BYTES or whole + size >= CHUNK_BYTES:
                    yield part(number, held, asked)
                    held, size, whole = [], 0, whole + size
                if whole >= CHUNK_BYTES:
                    yield from asked.rows(number, buckets)
                    asked, whole, number = _Asked(), 0, number + 1
        if held:
            yield part(number, held, asked)
        if held or whole:
            yield from asked.rows(number, buckets)

    return work


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            # Rows are large: one at a time.
            yield batch.slice(i, 1).to_pylist()[0]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``latest, key, n``: summed counts of every run, from the rows of whole buckets."""
    at, keys, counts, held = None, [], [], 0

    def merged():
        nonlocal keys, counts, held
        if not keys:
            return
        found, of = np.unique(np.concatenate(keys), return_inverse=True)
        keys, counts = [found], [np.bincount(of, np.concatenate(counts), len(found))]
        held = 0

    def out() -> Iterator[pa.RecordBatch]:
        merged()
        if keys:
            turned = _turned(keys[0])
            for i in range(0, len(turned), 1 << 16):
                part = turned[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.view(np.int64)), pa.array(counts[0][i : i + (1 << 16)].astype(np.int64))],
                    ["key", "n"],
                )

    for row in _each(batches):
        if row["bucket"] != at:
            yield from out()
            at, keys, counts, held = row["bucket"], [], [], 0
        keys.append(_unpack_sorted(row["body"]))
        counts.append(_unpack(row["more"], "<i8").astype(np.float64))
        held += len(keys[-1])
        if held > 1 << 21:
            merged()
    yield from out()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket: its words and their counts, ``n`` all of them."""
    schema = _arrow(_PIECES)
    at, total = None, Counter()

    def out() -> Iterator[pa.RecordBatch]:
        taught = [w for w, n in total.items() if n]
        if taught:
            counts = np.fromiter(map(total.__getitem__, taught), "<i8", len(taught))
            body = _pack(b" ".join(taught))
            yield _batch([("model", len(taught), at, int(counts.sum()), body, _pack(counts))], schema)

    for row in _each(batches):
        if row["bucket"] != at:
            yield from out()
            at, total = row["bucket"], Counter()
        words, counts = _unpack(row["body"]).split(), _unpack(row["more"], "<i8").tolist()
        for word, n in zip(words, counts, strict=True):
            total[word] += n
    yield from out()


class _Tier:
    """Groups of rows with one context of ``shallow`` bytes, mixed from ``deep`` bytes up.

    Rows are ``grp, kind, key, n, body``, sorted so that a group's handed-down rows (kind 0)
    come before its own (kind 1). As many whole groups as make ``_GROUP_ROWS`` go at once.
    """

    def __init__(self, deep: int, shallow: int):
        self.deep, self.shallow = deep, shallow

    def groups(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= _GROUP_ROWS:
                table = pa.Table.from_batches(held)
                of = table.column("grp").to_numpy()
                cut = int(np.searchsorted(of, of[-1]))
                if cut:
                    yield table.slice(0, cut)
                    table = table.slice(cut)
                held, size = table.to_batches(), table.num_rows
        if held:
            yield pa.Table.from_batches(held)

    def levels(self, table: pa.Table, below: np.ndarray | None) -> list[tree.Level]:
        keys = table.column("key").to_numpy().view(np.uint64)
        return tree.climb(keys, table.column("n").to_numpy(), self.deep - self.shallow + 1, below)

    @staticmethod
    def matrix(table: pa.Table, width: int) -> np.ndarray:
        return np.frombuffer(b"".join(table.column("body").to_pylist()), "<f8").reshape(-1, width)


def _rows(keys: np.ndarray, counts: np.ndarray, bodies: np.ndarray) -> Iterator[pa.RecordBatch]:
    wide = bodies.shape[1] * 8
    for i in range(0, len(keys), 1 << 14):
        part = np.ascontiguousarray(bodies[i : i + (1 << 14)], "<f8")
        packed = pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(wide), len(part), [None, pa.py_buffer(part.tobytes())]
        ).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys[i : i + (1 << 14)].view(np.int64)),
                pa.array(counts[i : i + (1 << 14)].astype(np.int64)),
                packed,
            ],
            ["key", "n", "body"],
        )


def _upward(tier: _Tier, leaf: bool):
    """The tier's shallowest rows, with the sums of what lies below them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tier.groups(batches):
            levels = tier.levels(table, None if leaf else tier.matrix(table, tree.BITS))
            yield from _rows(levels[-1].keys, levels[-1].counts, tree.passed_up(levels))

    return work


def _downward(tier: _Tier, leaf: bool, root: bool, buckets: int):
    """What the tier's deepest rows are handed; of the deepest tier, their log probabilities."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tier.groups(batches):
            own = table.filter(pa.compute.equal(table.column("kind"), 1))
            above = table.filter(pa.compute.equal(table.column("kind"), 0))
            levels = tier.levels(own, None if leaf else tier.matrix(own, tree.BITS))
            handed = None if root else tier.matrix(above, 2 * tree.BITS)
            down = tree.hand_down(levels, handed)
            if not leaf:
                yield from _rows(levels[0].keys, levels[0].counts, down)
                continue
            found = tree.log_probability(levels[0], down) / math.log(10)
            keys = _turned(levels[0].keys)
            order = np.argsort(keys)
            keys, found = keys[order], found[order]
            schema = _arrow(_PIECES)
            for bucket, at in _by_bucket(keys, buckets):
                body, more = _pack_sorted(keys[at]), _pack(found[at].astype("<f8"))
                yield _batch([("model", 0, bucket, len(at), body, more)], schema)

    return work


def _grouped(rows: DataFrame, depth: int, shallow: int) -> DataFrame:
    """Rows of contexts of ``depth`` bytes, those of one context of ``shallow`` bytes together."""
    group = F.shiftright("key", 8 * (depth - shallow) + 8)
    return rows.withColumn("grp", group)


def _together(rows: DataFrame) -> DataFrame:
    spread = rows.repartition(partitions(rows.sparkSession), "grp")
    return spread.sortWithinPartitions("grp", "kind", "key")


def _tree_log_probabilities(counted: DataFrame, buckets: int) -> DataFrame:
    """``bucket, body, more`` with the keys and log10 probabilities of all counted runs."""
    empty = F.lit(None).cast("binary")
    tiers = []
    rows = counted.withColumn("body", empty)
    for deep, shallow in TIERS:
        own = _grouped(rows, deep, shallow).withColumn("kind", F.lit(1))
        tiers.append((deep, shallow, own))
        if shallow:
            work = _upward(_Tier(deep, shallow), deep == DEPTH)
            rows = pin(map_batches(_together(own), work, "key bigint, n bigint, body binary"), "contexts")
    handed = None
    for deep, shallow, own in reversed(tiers):
        if handed is not None:
            above = handed.withColumns({"grp": F.shiftright("key", 8), "kind": F.lit(0)})
            own = own.unionByName(above)
        leaf = deep == DEPTH
        work = _downward(_Tier(deep, shallow), leaf, shallow == 0, buckets)
        schema = _PIECES if leaf else "key bigint, n bigint, body binary"
        found = map_batches(_together(own), work, schema)
        handed = found if leaf else pin(found, "handed")
    return handed


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk's row of a bucket, the model's values and, in the same order, what it asked."""
    schema = _arrow(_PIECES)
    at, parts, ready, values = None, [], None, None
    for row in _each(batches):
        if row["bucket"] != at:
            at, parts, ready = row["bucket"], [], None
        if row["kind"] == "model":
            parts.append((row["body"], row["more"]))
            continue
        if row["kind"] == "gram":
            if ready is None:
                ready = np.concatenate([_unpack_sorted(b) for b, _ in parts])
                values = np.concatenate([_unpack(m, "<f8") for _, m in parts])
                order = np.argsort(ready)
                ready, values, parts = ready[order], values[order], []
            found = values[np.searchsorted(ready, _unpack_sorted(row["body"]))].astype("<f4")
        else:
            if ready is None:
                ready = {}
                for body, more in parts:
                    ready |= zip(_unpack(body).split(), _unpack(more, "<i8").tolist(), strict=True)
                parts = []
            asked = _unpack(row["body"]).split()
            found = np.array([ready.get(w, 0) for w in asked], "<i8")
        yield _batch([(row["kind"], row["chunk"], at, len(found), _pack(found), row["body"])], schema)


def _answered(model: DataFrame, asked: DataFrame) -> DataFrame:
    asked = asked.withColumn("more", F.lit(None).cast("binary"))
    both = model.unionByName(asked).withColumn("later", F.col("kind") != "model")
    dealt = both.repartition(partitions(both.sparkSession), "bucket")
    return map_batches(dealt.sortWithinPartitions("bucket", "later").drop("later"), _answer, _PIECES)


_SCORES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("bits_per_byte", T.DoubleType()),
    ]
)


def _sums(values: np.ndarray, of: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per stretch of ``of`` between two ``bounds`` the sum of ``values`` there, some megabytes at once."""
    out = np.zeros(len(bounds) - 1, values.dtype)
    first = 0
    while first < len(out):
        reach = int(np.searchsorted(bounds, bounds[first] + (1 << 21)))
        last = min(max(reach - 1, first + 1), len(out))
        sums = np.concatenate(([0], np.cumsum(values[of[bounds[first] : bounds[last]]])))
        own = bounds[first : last + 1] - bounds[first]
        out[first:last] = sums[own[1:]] - sums[own[:-1]]
        first = last
    return out


class _Answers:
    """What a chunk was answered: the values of its byte runs and the counts of its words."""

    def __init__(self, rows: list[dict]):
        grams = [r for r in rows if r["kind"] == "gram"]
        keys = np.concatenate([_unpack_sorted(r["more"]) for r in grams])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.values = np.concatenate([_unpack(r["body"], "<f4") for r in grams])[order]
        words = [r for r in rows if r["kind"] == "word"]
        kind = pa.large_binary()
        self.words = pa.chunked_array([pa.array(_unpack(r["more"]).split(), kind) for r in words], kind)
        self.counts = np.concatenate([np.empty(0, "<i8"), *(_unpack(r["body"], "<i8") for r in words)])

    def of_keys(self, keys: np.ndarray) -> np.ndarray:
        return self.values[np.searchsorted(self.keys, keys)].astype(np.float64)

    def of_words(self, words: pa.LargeBinaryArray) -> np.ndarray:
        return self.counts[pa.compute.index_in(words, self.words).to_numpy()].astype(np.float64)


def _score(teachers: int, tokens: int, distinct: int):
    """Adds up what the documents of a chunk's parts were answered."""
    schema = _arrow(_SCORES)
    unseen = tokens + distinct + 1

    def scored(row: dict, answers: _Answers) -> pa.RecordBatch:
        meta = _unpack(row["more"], "<i8").reshape(-1, 4)
        whole = _unpack(row["body"])
        ends = np.cumsum(meta[:, 3]).tolist()
        part = _Part([whole[e - n : e] for e, n in zip(ends, meta[:, 3].tolist(), strict=True)])
        del whole, row["body"]
        first, of, words = part.words()
        counts = answers.of_words(words)
        n_words = np.diff(first) + 1
        known = _sums((counts > 0).astype(np.int64), of, first) + (teachers > 0)
        base = _sums(np.log10((counts + 1) / unseen), of, first) + math.log10((teachers + 1) / unseen)
        del words, of, counts
        grams, own = part.grams()
        values = np.zeros(len(grams.keys))
        values[own] = answers.of_keys(grams.keys[own])
        scores = _sums(values, grams.ids, np.append(part.starts, len(grams.ids)))
        bits = -scores * math.log2(10) / (meta[:, 3] + 1)
        ids = [i if there else None for there, i in meta[:, :2].tolist()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(meta[:, 2].astype(bool)),
                pa.array(n_words, pa.int64()),
                pa.array(known, pa.int64()),
                pa.array(np.full(len(meta), tokens)),
                pa.array(base, pa.float64()),
                pa.array(scores),
                pa.array(meta[:, 3]),
                pa.array(bits),
            ],
            schema=schema,
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        answers = None
        for row in _each(batches):
            if row["kind"] != "text":
                answers = None
                rows.append(row)
                continue
            if answers is None:
                answers, rows = _Answers(rows), []
            yield scored(row, answers)

    return work


def _stride(places: int) -> int:
    """A step that visits all places, near their golden section.

    The first chunks of the tasks go to places in a row, those of one task that many apart, so
    that few meet whether many tasks made some chunks or one made many.
    """
    step = max(round(0.618 * places), 1)
    while math.gcd(step, places) > 1:
        step += 1
    return step


def scores(docs: DataFrame) -> DataFrame:
    """One row per document: the contract's columns, ``n_bytes`` and ``bits_per_byte``.

    The model is learned from the documents that are not held out, ``crc32(doc_id) % 7 != 2``,
    and scores all: ``score`` is the log10 probability of the text's bytes, A to Z in lower
    case, and of its end; ``bits_per_byte`` the code length with the end counted as a byte.
    NULL texts count as empty; a NULL id counts as empty text where it is hashed and stays
    NULL; repeated rows teach and are scored each. A text is scored whole, in one task.
    ``train_tokens`` is 0 and all bytes are equally likely where nothing teaches. Empty tables
    give no rows. Extra columns are ignored.
    """
    spark = docs.sparkSession
    doc_id = F.col("doc_id").cast("bigint")
    remainder = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % ONE_IN
    rows = docs.select(
        doc_id.alias("doc_id"), (remainder == HELD_OUT).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(max(partitions(spark), size // BUCKET_BYTES), MOST_BUCKETS)
    folder = new_folder(spark, "pieces")
    pieces = map_batches(rows, _gather(buckets), _PIECES)
    pieces.write.partitionBy("kind").options(**_LARGE_ROWS).parquet(folder)
    pieces = spark.read.schema(_PIECES).parquet(folder).select(*_PIECES.names)
    texts, words, grams = (pieces.where(F.col("kind") == k) for k in ("text", "word", "gram"))

    by_bucket = partitions(spark), "bucket"
    dealt = words.repartition(*by_bucket).sortWithinPartitions("bucket")
    word_model = pin(map_batches(dealt, _count_words, _PIECES), "words")
    teachers = texts.agg(F.sum("n")).first()[0] or 0
    # A model row's chunk holds the number of its words.
    distinct, total = word_model.agg(F.sum("chunk"), F.sum("n")).first()
    word_answers = _answered(word_model.withColumn("chunk", F.lit(0).cast("bigint")), words)

    dealt = grams.repartition(*by_bucket).sortWithinPartitions("bucket")
    counted = pin(map_batches(dealt, _count_grams, "key bigint, n bigint"), "grams")
    gram_answers = _answered(_tree_log_probabilities(counted, buckets), grams)

    tokens, known = (total or 0) + teachers, (distinct or 0) + (teachers > 0)
    both = texts.unionByName(word_answers).unionByName(gram_answers)
    chunks = max(partitions(spark), size // CHUNK_BYTES)
    made = F.col("chunk").bitwiseAND(_MADE)
    place = (F.shiftright("chunk", _TASK_BITS) + made * _stride(chunks)) % chunks
    by_chunk = both.withColumn("later", F.col("kind") == "text").repartitionById(chunks, place.cast("int"))
    ordered = by_chunk.sortWithinPartitions("chunk", "later").drop("later")
    return map_batches(ordered, _score(teachers, tokens, known), _SCORES)

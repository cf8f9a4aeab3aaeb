"""Repeated passages by prefix-partitioned suffix trees over words.

A document's suffixes start at its words. Only the upper part of their suffix tree
matters: an internal node as deep as a window of ``WINDOW`` words, with leaves in two
or more documents, is a passage to find. Three steps keep every group in memory:

1. Of the suffixes, those that start at a locally least ``PREFIX``-word hash are dealt
   by this prefix. Any two equal windows hold such a suffix at the same place, because
   the choice sees nothing but the window. A prefix that one document alone holds is a
   leaf, and all windows that hang on it are done with.
2. Windows that hang on a shared prefix are dealt by the longer prefix, all ``WINDOW``
   words. Suffixes that agree in it are the leaves below one deep node; the least
   document of a node keeps its passage, the others lose theirs.
3. Runs of nodes that follow one another in a document merge into maximal repeats.

Tasks send each prefix and each node once with the least document that they know, so a
passage that a third of all documents share costs a row per task, not one per document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import SPACES, map_batches, partitions
from tidemark.sources.scratch import pin

WINDOW = 13
PREFIX = 7
# A task gathers this many prefixes before it sorts and sends them.
_FLUSH = 2_000_000
_BLOCK = 1 << 18  # bytes of text that are hashed at once
_TEXT_BYTES = 4 << 20  # of texts whose windows are looked at together
_BASE = 0xD6E8FEB86659FD93
_SPARK_SEED = 42  # of Spark's xxhash64
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)
_TWIST = np.uint64(0x165667B19E3779F9)
_ONE = np.uint64(1)
_NO_SPACE = np.ones(256, np.bool_)
_NO_SPACE[[ord(c) for c in SPACES]] = False

# What a row without a sender holds.
_HIT, _DOCUMENT = -1, -2
_OUT = pa.schema([("target", pa.int32()), ("origin", pa.int32()), ("body", pa.binary())])
_ROWS = "target int, origin int, body binary"


def _powers(base: int) -> np.ndarray:
    """1, base, base squared, … modulo 2 ** 64, one more than a block has bytes."""
    table = np.full(_BLOCK + 1, base, np.uint64)
    table[0] = 1
    return np.cumprod(table, dtype=np.uint64)


class _PowerTable:
    """Powers of an odd number and of its inverse, grown for words longer than a block."""

    def __init__(self) -> None:
        self.up, self.down = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))

    def reach(self, size: int) -> None:
        while len(self.up) <= size:
            n = len(self.up)
            self.up, self.down = (
                np.concatenate((t, t[1:n] * t[n - 1])) for t in (self.up, self.down)
            )


_table: list[_PowerTable] = []


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * _ODD
    return h ^ (h >> np.uint64(29))


class Words:
    """Hashes of all words of a string column, document after document.

    A word's hash is a polynomial of its bytes, from differences of running sums over the
    column's own buffer, so no word becomes an object.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("")
        wide = pa.types.is_large_string(texts.type)
        _, places, body = texts.buffers()
        offsets = np.frombuffer(places, np.int64 if wide else np.int32) if places else np.zeros(1, np.int32)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        low, high = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
        octets = np.frombuffer(body, np.uint8)[low:high] if body else np.empty(0, np.uint8)
        starts, stops = _word_edges(octets, offsets - low)
        self.counts = np.diff(np.searchsorted(starts, offsets - low)) if len(texts) else np.empty(0, np.int64)
        self.owner = np.repeat(np.arange(len(texts), dtype=np.int64), self.counts)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.hashes = _hashed(octets, starts, stops)


def _word_edges(octets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end; a document's end also ends a word."""
    inside = _NO_SPACE[octets]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    at = offsets[(offsets > 0) & (offsets < len(octets))]
    begins[at], ends[at - 1] = inside[at], inside[at - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _hashed(octets: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    if not _table:
        _table.append(_PowerTable())
    table = _table[0]
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = int(starts[first])
        last = max(first + 1, int(np.searchsorted(stops, low + _BLOCK, "right")))
        high = int(stops[last - 1])
        table.reach(high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((octets[low:high].astype(np.uint64) + _ONE) * table.up[: high - low], out=sums[1:])
        begin, end = starts[first:last] - low, stops[first:last] - low
        out[first:last] = (sums[end] - sums[begin]) * table.down[begin]
        first = last
    return _mixed(out + (stops - starts).astype(np.uint64) * _TWIST)


def rolling(hashes: np.ndarray, size: int, factor: np.uint64 = _ODD) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive words, put together from powers of two."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    total, done = np.zeros(n, np.uint64), 0
    part, width, power = hashes, 1, factor
    while width <= size:
        if size & width:
            # The places already covered come first; this part follows them.
            total = total * power + part[done : done + n]
            done += width
        if 2 * width <= size:
            part = part[:-width] * power + part[width:]
        width, power = 2 * width, power * power
    return _mixed(total)


def anchors(words: Words, window: int = WINDOW, prefix: int = PREFIX):
    """Windows that lie in one document, each with its least prefix's place, and all prefixes."""
    n = len(words.hashes) - window + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = rolling(words.hashes, prefix)
    least, place = grams[:n].copy(), np.arange(n)
    for step in range(1, window - prefix + 1):
        less = grams[step : step + n] < least
        np.copyto(least, grams[step : step + n], where=less)
        np.copyto(place, np.arange(step, step + n), where=less)
    at = np.flatnonzero(words.owner[:n] == words.owner[window - 1 :])
    return at, place[at], grams


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows in sorted keys, with the end."""
    if not len(keys[0]):
        return np.zeros(1, np.int64)
    differs = np.zeros(len(keys[0]) - 1, bool)
    for key in keys:
        differs |= key[1:] != key[:-1]
    return np.concatenate(([0], np.flatnonzero(differs) + 1, [len(keys[0])]))


def _pack(*arrays: np.ndarray) -> bytes:
    """Equally long arrays of 64-bit numbers."""
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpack(body: bytes, count: int) -> list[np.ndarray]:
    each = len(body) // count // 8
    whole = np.frombuffer(body, np.uint64).reshape(count, each)
    return list(whole)


def _send(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OUT, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_OUT)


def _signed_order(ids: np.ndarray) -> np.ndarray:
    """Ids in their signed order; they travel as unsigned numbers."""
    return ids.view(np.int64)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    """The group of a document, from its id alone; ``_group_column`` is the same in Spark."""
    known, back = np.unique(ids.view(np.int64), return_inverse=True)
    digest = xxhash.xxh64_intdigest
    hashes = [digest(i.to_bytes(8, "little", signed=True), _SPARK_SEED) for i in known.tolist()]
    return np.mod(np.array(hashes, np.uint64).view(np.int64), groups)[back]


def _split(place: np.ndarray, count: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted places."""
    edges = np.searchsorted(place, np.arange(count + 1))
    for i in np.flatnonzero(np.diff(edges)).tolist():
        yield i, slice(edges[i], edges[i + 1])


def _send_prefixes(buckets: int, window: int, prefix: int):
    """Step 1, at the documents: each task sends every prefix it knows once, and its hits.

    Body: prefixes, ids, and whether the task itself saw two documents with the prefix.
    Documents that share a prefix inside the task need no answer; they are sent on as
    hits, to the bucket with the number of their group.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for part in _parts(batch):
                words = Words(part.column(1))
                _, places, grams = anchors(words, window, prefix)
                chosen = _distinct(places)
                keys.append(grams[chosen])
                numbers = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids.append(numbers[words.owner[chosen]])
                held += len(chosen)
                if held >= _FLUSH:
                    yield from flush(keys, ids)
                    keys, ids, held = [], [], 0
        if held:
            yield from flush(keys, ids)

    def flush(keys, ids) -> Iterator[pa.RecordBatch]:
        key, doc = np.concatenate(keys), np.concatenate(ids)
        keys.clear()
        ids.clear()
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        del order
        edges = _runs(key)
        first, last = edges[:-1], edges[1:] - 1
        several = doc[first] != doc[last]
        for bucket, part in _split(_bucket(key[first], buckets), buckets):
            body = _pack(key[first][part], doc[first][part].view(np.uint64), several[part].astype(np.uint64))
            yield _send([(bucket, 0, body)])
        hit = np.repeat(several, np.diff(edges))
        yield from _send_hits(key[hit], doc[hit], buckets, 1)

    return work


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with not much more than ``_TEXT_BYTES`` of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    groups = np.cumsum(sizes.astype(np.int64)) // _TEXT_BYTES
    edges = _runs(groups)
    for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield batch.slice(start, stop - start)


def _distinct(places: np.ndarray) -> np.ndarray:
    """Places in rising order, each once; windows choose in rising order."""
    return places[np.concatenate(([True], places[1:] != places[:-1]))] if len(places) else places


def _share_prefixes(groups: int):
    """Step 1, at the prefixes: which documents hold a prefix that another document holds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, flags = [], [], []
        for batch in batches:
            for target, origin, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if origin:
                    yield _send([(target, _HIT, body)])
                    continue
                key, doc, several = _unpack(body, 3)
                keys.append(key)
                ids.append(doc.view(np.int64))
                flags.append(several)
        if not keys:
            return
        key, doc, several = np.concatenate(keys), np.concatenate(ids), np.concatenate(flags)
        del keys, ids, flags
        order = np.lexsort((doc, key))
        key, doc, several = key[order], doc[order], several[order]
        del order
        edges = _runs(key)
        first, last = edges[:-1], edges[1:] - 1
        shared = (doc[first] != doc[last]) | (np.add.reduceat(several, first) > 0)
        hit = np.repeat(shared, np.diff(edges)) & (several == 0)
        yield from _send_hits(key[hit], doc[hit], groups, _HIT)

    return work


def _send_hits(key: np.ndarray, doc: np.ndarray, groups: int, origin: int) -> Iterator[pa.RecordBatch]:
    """Shared prefixes and the documents that hold them, to the documents' groups."""
    group = _group_of(doc, groups)
    order = np.lexsort((key, doc, group))
    key, doc = key[order], doc[order]
    for target, part in _split(group[order], groups):
        yield _send([(target, origin, _pack(key[part], doc[part].view(np.uint64)))])


class _Group:
    """All documents of a group, the prefixes that they share with others, and its nodes.

    The group's nodes are the distinct windows that hang on a shared prefix, in the order
    of their hashes, with the least document of the group that has each. The order follows
    from the documents alone, so a second task that sees them finds the same nodes.
    """

    def __init__(self, docs: pa.Table, hits: list[bytes], window: int, prefix: int):
        self.window = window
        shared = [_unpack(h, 2) for h in hits]
        none = [np.empty(0, np.uint64)]
        key = np.concatenate([s[0] for s in shared] or none)
        doc = np.concatenate([s[1] for s in shared] or none)
        known = np.sort(_mixed(key + doc * _TWIST))
        # Windows lie in one document, so a group's words need not be in memory together.
        found = [([], np.empty(0, np.int64), *none, *none, np.empty(0, np.int64))]
        n_words = 0
        for batch in docs.select([0, 1]).to_batches():
            for part in _parts(batch):
                found.append(_shared_windows(part, known, n_words, window, prefix))
                n_words += int(np.sum(found[-1][0]))
        self.counts = np.concatenate([f[0] for f in found]).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        at, high, low, doc = (np.concatenate([f[i] for f in found]) for i in range(1, 5))
        del found
        order = np.lexsort((doc, low, high))
        self.place, self.doc = at[order], doc[order]
        high, low = high[order], low[order]
        edges = _runs(high, low)
        self.node = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        first = edges[:-1]
        self.high, self.low, self.least = high[first], low[first], self.doc[first]

    def removed(self, elsewhere: np.ndarray) -> np.ndarray:
        """Which words go. ``elsewhere``: nodes with a lesser document elsewhere."""
        gone = (self.doc > self.least[self.node]) | elsewhere[self.node]
        change = np.zeros(int(self.first[-1]) + 1, np.int8)
        # One window starts at a place at most, so no addition is lost.
        change[self.place[gone]] += 1
        change[self.place[gone] + self.window] -= 1
        return np.cumsum(change, dtype=np.int32)[:-1] > 0


def _shared_windows(part: pa.RecordBatch, known: np.ndarray, before: int, window: int, prefix: int):
    """Words per document, and place, two hashes and document of windows with a prefix of ``known``.

    ``before``: how many words of the group lie before the part.
    """
    ids, words = part.column(0), Words(part.column(1))
    at, places, grams = anchors(words, window, prefix)
    if ids.null_count:
        named = ids.is_valid().to_numpy(zero_copy_only=False)[words.owner[at]]
        at, places = at[named], places[named]
    numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    # A chance hit only adds a window that turns out not to be shared.
    asked = _mixed(grams[places] + numbers[words.owner[at]].view(np.uint64) * _TWIST)
    if len(known):
        found = np.minimum(np.searchsorted(known, asked), len(known) - 1)
        at = at[known[found] == asked]
    else:
        at = at[:0]
    none = np.empty(0, np.uint64)
    high = rolling(words.hashes, window)[at] if len(at) else none
    low = rolling(words.hashes ^ _TWIST, window, _ODD2)[at] if len(at) else none
    return words.counts, at + before, high, low, numbers[words.owner[at]]


def _read_group(batches: Iterator[pa.RecordBatch], kept: int):
    """Documents in the order of their ids and texts, hits and answers of each group in a task."""
    tables: dict[int, list] = {}
    for batch in batches:
        target, origin = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        at = sorted(set(target))
        for group in at:
            tables.setdefault(group, [[], [], []])
        bodies = batch.column(2)
        for i in np.flatnonzero(origin != _DOCUMENT).tolist():
            slot = tables[target[i]][0 if origin[i] == _HIT else 1]
            body = bodies[i].as_py()
            slot.append(body if origin[i] == _HIT else (int(origin[i]), body))
        docs = pa.Table.from_batches([batch]).select(range(3, 5 + kept))
        targets = np.array(target)
        for group in at:
            mine = np.flatnonzero((origin == _DOCUMENT) & (targets == group))
            if len(mine):
                tables[group][2].append(docs.take(pa.array(mine)))
    for group in sorted(tables):
        hits, answers, parts = tables.pop(group)
        if not parts:
            continue
        docs = pa.concat_tables(parts)
        ids, texts = docs.column(0).to_pylist(), docs.column(1)
        times = Counter(ids)

        def place(i: int, ids=ids, texts=texts, times=times) -> tuple:
            # Texts only matter where rows share an id.
            text = texts[i].as_py() if times[ids[i]] > 1 else None
            return (ids[i] is not None, ids[i] or 0, text or "")

        docs = docs.take(pa.array(sorted(range(len(ids)), key=place), pa.int64()))
        del parts, ids, texts, times, place
        yield group, docs, hits, dict(answers)


def _send_nodes(buckets: int, window: int, prefix: int):
    """Step 2, at the documents: every node of the group once, with its least document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for origin, docs, hits, _ in _read_group(batches, 0):
            group = _Group(docs, hits, window, prefix)
            least = group.least.view(np.uint64)
            for bucket, part in _split(_bucket(group.high, buckets), buckets):
                body = _pack(group.high[part], group.low[part], least[part])
                yield _send([(bucket, origin, body)])

    return work


def _answer_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2, at the nodes: per sender, one bit for each node with a lesser document elsewhere."""
    by_bucket: dict[int, list[tuple[int, bytes]]] = {}
    for batch in batches:
        for bucket, origin, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            by_bucket.setdefault(bucket, []).append((origin, body))
    for bucket, sent in by_bucket.items():
        parts = [_unpack(body, 3) for _, body in sent]
        high, low, doc = (np.concatenate([p[i] for p in parts]) for i in range(3))
        doc = _signed_order(doc)
        order = np.lexsort((doc, low, high))
        edges = _runs(high[order], low[order])
        least = np.empty(len(doc), np.int64)
        least[order] = np.repeat(doc[order][edges[:-1]], np.diff(edges))
        lesser = least < doc
        start = 0
        for (origin, _), part in zip(sent, parts, strict=True):
            stop = start + len(part[0])
            bits = np.packbits(lesser[start:stop]).tobytes()
            yield _send([(origin, bucket, (stop - start).to_bytes(8, "little") + bits)])
            start = stop


def _finish(buckets: int, window: int, prefix: int, kept: int, schema: pa.Schema):
    """Step 3, at the documents: merge what goes into spans and drop it from the text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, docs, hits, answers in _read_group(batches, kept):
            group = _Group(docs, hits, window, prefix)
            elsewhere = np.zeros(len(group.high), bool)
            for bucket, part in _split(_bucket(group.high, buckets), buckets):
                n = part.stop - part.start
                body = answers[bucket]
                if int.from_bytes(body[:8], "little") != n:
                    raise RuntimeError("a group's nodes differ from those sent before")
                elsewhere[part] = np.unpackbits(np.frombuffer(body[8:], np.uint8), count=n)
            removed = group.removed(elsewhere)
            first = group.first.tolist()
            some = np.add.reduceat(np.append(removed, False), group.first[:-1]) if len(docs) else []
            some = np.where(group.counts > 0, some, 0).tolist()
            spans, rest = [], []
            for i, text in enumerate(docs.column(1)):
                words = (text.as_py() or "").encode().split()
                if some[i]:
                    gone = removed[first[i] : first[i + 1]]
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
                    pairs = edge.reshape(-1, 2).tolist()
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                else:
                    pairs = []
                spans.append([{"start": a, "length": b - a} for a, b in pairs])
                rest.append(b" ".join(words).decode())
            sizes = group.counts
            columns = [docs.column(n) for n in schema.names[:-3]]
            made = [*columns, pa.array(sizes, pa.int64())]
            made += [pa.array(spans, schema.field("repeats").type), pa.array(rest, pa.string())]
            table = pa.Table.from_arrays(
                [c.cast(f.type) for c, f in zip(made, schema, strict=True)], schema=schema
            )
            yield from table.to_batches(max_chunksize=2048)

    return work


def _by_target(rows: DataFrame, count: int) -> DataFrame:
    return rows.repartitionById(count, F.col("target"))


def repeats(
    docs: DataFrame,
    *keep: str,
    with_text: bool = False,
    window: int = WINDOW,
    prefix: int = PREFIX,
    groups: int | None = None,
) -> DataFrame:
    """Passages that repeat an earlier document, and each text without them.

    Returns ``doc_id``, with ``with_text`` also ``text``, the ``keep`` columns, ``n_words``,
    ``repeats`` (maximal spans of words, each covered by windows whose words also start in a
    document with a lesser id) and ``kept_text`` (the other words, joined by one blank), one
    row per row of ``docs``.

    NULL texts have no words. Rows without an id neither lose words nor cost others any.
    Rows that share an id are one document: none repeats the other, and what any of them
    holds counts for all greater ids. Words are compared by two 64-bit hashes of the
    whole window.
    """
    if not 1 <= prefix <= window:
        raise ValueError("the prefix must fit into the window")
    spark = docs.sparkSession
    groups = groups or partitions(spark)
    names = [f"__keep{i}" for i in range(len(keep))]
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *(F.col(k).alias(n) for k, n in zip(keep, names, strict=True)),
    )
    known = rows.select("doc_id", "text").dropna()
    sent = map_batches(known, _send_prefixes(groups, window, prefix), _ROWS)
    hits = map_batches(_by_target(sent, groups), _share_prefixes(groups), _ROWS)
    hits = pin(hits, "shared-prefixes")

    def grouped(more: DataFrame, *columns: str) -> DataFrame:
        """Documents with the rows for their group, one group to a task."""
        ids = F.col("doc_id")
        whole = rows.select(
            _group_column(ids, F.col("text"), groups).alias("target"),
            F.lit(_DOCUMENT).alias("origin"),
            F.lit(None).cast("binary").alias("body"),
            "doc_id",
            "text",
            *columns,
        )
        return _by_target(whole.unionByName(more, allowMissingColumns=True), groups)

    nodes = map_batches(grouped(hits), _send_nodes(groups, window, prefix), _ROWS)
    answers = pin(map_batches(_by_target(nodes, groups), _answer_nodes, _ROWS), "answers")
    shown = ["doc_id", *(["text"] if with_text else []), *names]
    types = dict(rows.dtypes)
    out = ", ".join(f"`{n}` {types[n]}" for n in shown)
    out += ", n_words bigint, repeats array<struct<start:bigint,length:bigint>>, kept_text string"
    both = grouped(hits.unionByName(answers), *names)
    schema = _arrow_schema(rows.select(*shown))
    done = map_batches(both, _finish(groups, window, prefix, len(names), schema), out)
    return done.withColumnsRenamed(dict(zip(names, keep, strict=True)))


def _arrow_schema(shown: DataFrame) -> pa.Schema:
    fields = list(to_arrow_schema(shown.schema))
    span = pa.struct([("start", pa.int64()), ("length", pa.int64())])
    fields += [
        pa.field("n_words", pa.int64()),
        pa.field("repeats", pa.list_(span)),
        pa.field("kept_text", pa.string()),
    ]
    return pa.schema(fields)


def _group_column(doc_id: Column, text: Column, groups: int) -> Column:
    """The group of a row; it equals ``_group_of`` for rows with an id."""
    hashed = F.when(doc_id.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(doc_id))
    return F.pmod(hashed, F.lit(groups)).cast("int")


def without_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """``docs`` with shortened texts: all rows and columns stay.

    A text that loses nothing stays as it is; another becomes its kept words, joined by
    one blank, and ``n_chars`` its new length. A text that repeats whole becomes empty.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    chars = [c for c in docs.columns if c == "n_chars"]
    found = repeats(docs, *others, *chars, with_text=True, window=window, prefix=prefix)
    lost = F.size("repeats") > 0
    text = F.when(lost, F.col("kept_text")).otherwise(F.col("text"))
    made = {"text": text}
    if chars:
        length = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
        made["n_chars"] = F.when(lost, length).otherwise(F.col("n_chars"))
    columns = [made[c].alias(c) if c in made else F.col(c) for c in docs.columns]
    return found.select(*columns)

"""Language identification with hyperdimensional letter-n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, map_batches

DIMENSIONS = 1024
UNKNOWN = "und"
_SEED = 20_240
_BITS = 21  # of a code point
_TABLE_ROWS = 24_576  # n-gram vectors that a worker keeps; beyond that it starts afresh


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """1 where the code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)


def trigrams(text: str) -> np.ndarray:
    """Keys of all letter trigrams; a run of other characters counts as one blank, code 0."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(_letters()[points], points, 0).astype(np.uint64)
    if not codes.any():
        return np.empty(0, np.uint64)
    codes = np.concatenate(([0], codes, [0])).astype(np.uint64)
    codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
    return codes[:-2] << np.uint64(2 * _BITS) | codes[1:-1] << np.uint64(_BITS) | codes[2:]


class NgramVectors:
    """Random letter vectors of +1 and -1, bound into trigram vectors.

    A letter's vector follows from its code point alone, so every worker makes the same.
    A trigram is the elementwise product of its letters' vectors, the first rotated by
    two places and the second by one, so that order counts.
    """

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self._letter: dict[int, np.ndarray] = {}
        self._row: dict[int, int] = {}
        self._table = np.empty((1024, dimensions), np.float32)

    def letter(self, point: int) -> np.ndarray:
        if point not in self._letter:
            bits = np.random.Generator(np.random.Philox(key=[_SEED, point])).integers(
                0, 2, self.dimensions
            )
            self._letter[point] = (2 * bits - 1).astype(np.float32)
        return self._letter[point]

    def _vector(self, key: int) -> np.ndarray:
        mask = (1 << _BITS) - 1
        first, second, third = key >> 2 * _BITS, key >> _BITS & mask, key & mask
        rolled = np.roll(self.letter(first), 2) * np.roll(self.letter(second), 1)
        return rolled * self.letter(third)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """One vector per key; at most ``_TABLE_ROWS`` keys at once."""
        if len(self._row) + len(keys) > _TABLE_ROWS:
            self._row.clear()
        at = []
        for key in keys.tolist():
            row = self._row.get(key)
            if row is None:
                row = self._row[key] = len(self._row)
                if row >= len(self._table):
                    wider = np.empty((2 * len(self._table), self.dimensions), np.float32)
                    wider[: len(self._table)] = self._table
                    self._table = wider
                self._table[row] = self._vector(key)
            at.append(row)
        return self._table[at]

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the keys' vectors, each as often as it occurs."""
        total = np.zeros(self.dimensions, np.float64)
        for i in range(0, len(keys), 4096):
            total += counts[i : i + 4096].astype(np.float32) @ self.rows(keys[i : i + 4096])
        return total


@lru_cache(maxsize=2)
def _vectors(dimensions: int) -> NgramVectors:
    return NgramVectors(dimensions)


def _texts_by_language(batch: pa.RecordBatch) -> dict[str, list[str]]:
    by_lang: dict[str, list[str]] = {}
    for text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        by_lang.setdefault(lang, []).append(text)
    return by_lang


def learn(labelled: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """A unit prototype per ``lang`` from the texts of ``labelled (text, lang)``, all rows.

    Each task bundles its texts per language; Spark adds the bundles up. What reaches
    the driver is ``dimensions`` numbers per language. NULL texts and languages teach
    nothing; a language whose texts hold no letter is not learned.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = _vectors(dimensions)
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, texts in _texts_by_language(batch).items():
                # A blank apart, so that no trigram spans two texts' letters.
                for i in range(0, len(texts), 256):
                    keys, n = np.unique(trigrams(" ".join(texts[i : i + 256])), return_counts=True)
                    if len(keys):
                        bundled = vectors.bundle(keys, n)
                        totals[lang] = totals.get(lang, 0) + bundled
        schema = pa.schema([("lang", pa.string()), ("bundle", pa.list_(pa.int64()))])
        yield from batches_of(
            ((k, np.rint(v).astype(np.int64).tolist()) for k, v in totals.items()), schema
        )

    known = labelled.select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).dropna()
    parts = map_batches(known, bundle, "lang string, bundle array<bigint>")
    summed = (
        parts.select("lang", F.posexplode("bundle").alias("at", "value"))
        .groupBy("lang", "at")
        .agg(F.sum("value").alias("value"))
    )
    prototypes: dict[str, np.ndarray] = {}
    for row in summed.collect():
        prototypes.setdefault(row.lang, np.zeros(dimensions))[row.at] = row.value
    units = {k: v / n for k, v in sorted(prototypes.items()) if (n := np.linalg.norm(v))}
    return units


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], *keep: str) -> DataFrame:
    """``keep`` columns plus ``lang_pred`` and ``score``, the cosine with the nearest prototype.

    ``score`` is 0 where the cosine is negative. A NULL text, one without a letter, and any
    text when nothing was learned get ``und`` and 0; equal cosines go to the first language
    by name. Only ``text`` is looked at.
    """
    names = sorted(prototypes)
    dimensions = len(prototypes[names[0]]) if names else DIMENSIONS
    matrix = np.array([prototypes[n] for n in names], np.float64)

    def score(text: str | None) -> tuple[str, float]:
        keys = trigrams(text) if text and names else ()
        if not len(keys):
            return UNKNOWN, 0.0
        found, counts = np.unique(keys, return_counts=True)
        bundled = _vectors(dimensions).bundle(found, counts)
        cosines = matrix @ bundled / (np.linalg.norm(bundled) or 1.0)
        best = int(np.argmax(cosines))
        return names[best], float(min(max(cosines[best], 0.0), 1.0))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [score(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            names_of = pa.array([f[0] for f in found], pa.string())
            scores = pa.array([f[1] for f in found], pa.float64())
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            labels = [*batch.schema.names[:-1], "lang_pred", "score"]
            yield pa.RecordBatch.from_arrays([*kept, names_of, scores], labels)

    rows = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    schema = "".join(f"`{n}` {t}, " for n, t in rows.dtypes[:-1]) + "lang_pred string, score double"
    return map_batches(rows, work, schema)


def held_out(doc_id: str = "doc_id"):
    """The third of the documents that prototypes never see. A NULL id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text) % F.lit(3) == F.lit(1)


def identify(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """Learn from the documents that are not held out and predict all of them."""
    marked = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", held_out().alias("held_out")
    )
    prototypes = learn(marked.where(~F.col("held_out")), dimensions)
    return predict(marked, prototypes, "doc_id", "held_out")

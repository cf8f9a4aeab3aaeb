"""Packing by power-of-two decomposition: no sequence crosses documents, none is padded."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, map_batches
from tidemark.llm.tokens import END_ID, VOCABULARY, encoder
from tidemark.operators.keys import dense_keys
from tidemark.sources.scratch import pin

MAX_LENGTH = 2048
_ID_BYTES = 4

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("ids", pa.binary()),
    ]
)
# A batch is sent on once it holds this many bytes of ids.
_BATCH_BYTES = 8 << 20


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """``n`` as powers of two, longest first, none above ``longest`` (itself a power of two)."""
    whole, rest = divmod(n, longest)
    lengths = [longest] * whole
    bit = longest >> 1
    while bit:
        if rest & bit:
            lengths.append(bit)
        bit >>= 1
    return lengths


def pieces(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    longest: int = MAX_LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """Every document's tokens plus ``end_id``, cut into pieces of power-of-two length.

    Returns ``doc_id, start, length, doc_tokens, ids``; ``ids`` are little-endian
    unsigned 32-bit numbers. A document of ``n`` tokens gives its whole multiples of
    ``longest`` and one piece per set bit of the rest, so each id lies in exactly one
    piece. NULL and empty texts give the end id alone. Rows are handled one by one:
    repeated rows and NULL ids each give their own pieces, and an empty table none.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"{longest} is no power of two")
    end = end_id.to_bytes(_ID_BYTES, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).packed
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = encode(text or "") + end
                n = len(ids) // _ID_BYTES
                start = 0
                for length in piece_lengths(n, longest):
                    stop = start + length
                    rows.append(
                        (doc_id, start, length, n, ids[start * _ID_BYTES : stop * _ID_BYTES])
                    )
                    start = stop
                held += len(ids)
                if held >= _BATCH_BYTES:
                    yield _table(rows)
                    rows, held = [], 0
        if rows:
            yield _table(rows)

    schema = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"
    return map_batches(id_and_text(docs), cut, schema)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_PIECES)


def number_sequences(cut: DataFrame) -> DataFrame:
    """Add ``sequence_id`` (0..n-1) and ``offset``: each piece is a sequence of its own.

    Sequences of one length are numbered in a row, longest first, so that a bucket of
    equal lengths is one range of ids and any batch from it has no padding. The pieces
    are written once; the sort then spreads even a bucket with most rows over all tasks.
    """
    fixed = pin(cut, "pieces")
    numbered = dense_keys(
        fixed, [F.col("length").desc(), "doc_id", "start"], "sequence_id", start=-1
    )
    return numbered.withColumn("offset", F.lit(0).cast("bigint"))


def packed_digest(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Where each piece of ``docs`` lies, with a checksum of its ids in their place."""
    cut = pieces(docs, vocabulary).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return number_sequences(cut)

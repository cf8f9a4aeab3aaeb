"""SimHash near-duplicates: blocks of bits propose, pivot distances discard, bits verify."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, id_and_text, map_batches, partitions
from tidemark.llm.components import components
from tidemark.sources.scratch import pin

SHINGLE = 4
MAX_BITS = 4
_SEED = 42
_WIDTH = 64
_PIVOTS = 16
_LANE = 8  # bits that one packed pivot distance takes
GROUP_LIMIT = 16_384  # fingerprints of a block value that one task compares
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of ``text``; 0 when it has no word.

    A-Z are lower-cased, words lie between white space, shingles are joined by one
    blank and hashed by XXH64. Fewer words than a shingle make one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, _SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    stops = ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], _SEED) for s, e in zip(starts, stops, strict=True)]
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    if len(hashes) < 256:
        ones = _BYTE_BITS[octets].sum(axis=0, dtype=np.int64).reshape(-1)
    else:
        counts = [np.bincount(octets[:, i], minlength=256) for i in range(8)]
        ones = (np.stack(counts) @ _BYTE_BITS.astype(np.int64)).reshape(-1)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``, one row per row of ``docs``; ``fp`` is the fingerprint as a signed 64-bit number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["doc_id", "fp"])

    return map_batches(id_and_text(docs), work, "doc_id bigint, fp bigint")


def _signed(number: int) -> int:
    return number - (1 << _WIDTH) if number >> (_WIDTH - 1) else number


def references(count: int = _PIVOTS) -> list[int]:
    """Well-spread reference fingerprints: rows of a Walsh matrix, any two 32 bits apart."""
    rows = [(37 * i + 11) % _WIDTH for i in range(count)]
    return [sum((bin(r & j).count("1") & 1) << j for j in range(_WIDTH)) for r in rows]


def _pivot_table(fp: str = "fp") -> list:
    """Distances to all references, eight to a 64-bit number."""
    fp_col = F.col(fp)
    lanes = [F.bit_count(fp_col.bitwiseXOR(F.lit(_signed(r)))).cast("bigint") for r in references()]
    packed = []
    per = _WIDTH // _LANE
    for i in range(0, _PIVOTS, per):
        whole = F.lit(0).cast("bigint")
        for j, lane in enumerate(lanes[i : i + per]):
            whole = whole.bitwiseOR(F.shiftleft(lane, j * _LANE))
        packed.append(whole.alias(f"pivots{i // per}"))
    return packed


def block_count(fingerprints_: int, bits: int = MAX_BITS) -> int:
    """Into how many blocks to cut fingerprints so that few share the blocks of a key.

    Two fingerprints ``bits`` apart agree in all but ``bits`` of the blocks. More blocks
    mean longer keys and more of them; every count finds all links.
    """
    blocks = bits + 2
    while fingerprints_ > 4 << (_WIDTH * (blocks - bits) // blocks) and blocks < bits + 6:
        blocks += 1
    return blocks


def _key_masks(blocks: int, bits: int) -> list[int]:
    """One mask per choice of ``blocks - bits`` blocks."""
    edges = [i * _WIDTH // blocks for i in range(blocks + 1)]
    whole = [sum(1 << j for j in range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(whole, blocks - bits)]


def spanning_links(fps: np.ndarray, table: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that connect what ``bits`` or fewer differing bits connect, fewer than rows.

    ``table`` has the rows' distances to the references. Two rows whose distances to any
    one reference differ by more than ``bits`` are further apart than that, so only rows
    within ``bits`` in the largest coordinate difference are compared bit by bit.
    """
    left = np.arange(len(fps))
    queue: list[int] = []
    links = []
    while len(left):
        if not queue:
            queue.append(int(left[0]))
            left = left[1:]
        here = queue.pop()
        near = np.abs(table[left] - table[here]).max(axis=1, initial=0) <= bits
        hit = np.zeros(len(left), bool)
        hit[near] = np.bitwise_count(fps[left[near]] ^ fps[here]) <= bits
        found = left[hit].tolist()
        links += [(here, f) for f in found]
        queue += found
        left = left[~hit]
    return links


def _link_groups(bits: int):
    """Per block value: the links among its fingerprints."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def links() -> Iterator[tuple[int, int]]:
            held: list[np.ndarray] = []
            for batch in batches:
                rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
                held.append(rows)
                rows = np.concatenate(held) if len(held) > 1 else rows
                # The last group may go on in the next batch.
                changes = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
                if not len(changes):
                    held = [rows]
                    continue
                yield from grouped(rows[: changes[-1]], np.concatenate(([0], changes)))
                held = [rows[changes[-1] :]]
            if held:
                rows = np.concatenate(held)
                yield from grouped(rows, np.array([0, len(rows)]))

        def grouped(rows: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, int]]:
            wide = np.flatnonzero(np.diff(edges) > 1)
            if not len(wide):
                return
            lanes = np.ascontiguousarray(rows[:, 4:]).view(np.int8).reshape(len(rows), -1)
            fps = rows[:, 3].copy().view(np.uint64)
            pairs = wide[np.diff(edges)[wide] == 2]
            first = edges[pairs]
            close = np.abs(lanes[first] - lanes[first + 1]).max(axis=1, initial=0) <= bits
            first = first[close]
            first = first[np.bitwise_count(fps[first] ^ fps[first + 1]) <= bits]
            yield from zip(rows[first, 3].tolist(), rows[first + 1, 3].tolist(), strict=True)
            for group in wide[np.diff(edges)[wide] > 2].tolist():
                start, stop = edges[group], edges[group + 1]
                own = rows[start:stop, 3]
                for i, j in spanning_links(fps[start:stop], lanes[start:stop], bits):
                    yield int(own[i]), int(own[j])

        yield from batches_of(links(), schema, 65_536)

    return work


def links(
    nodes: DataFrame, bits: int = MAX_BITS, limit: int = GROUP_LIMIT, blocks: int | None = None
) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints within ``bits`` bits of one another.

    ``nodes`` has distinct fingerprints ``fp``. Its table of distances to the references
    is computed once. References that differ from the zero fingerprint within one block
    only would tell a block's bits; equal blocks, of which two near fingerprints must
    have all but ``bits``, are therefore the first key. Within a key, the largest
    difference of the table's coordinates discards and the bits verify. A key with more
    than ``limit`` fingerprints is cut into pieces, and every two pieces meet in a task
    of their own, so that no link is lost and no task gets the whole key. Each task
    returns a forest, never all pairs.
    """
    table = pin(nodes.select("fp", *_pivot_table()), "pivots")
    blocks = blocks or block_count(table.count(), bits)
    keys = [F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in _key_masks(blocks, bits)]
    keyed = table.select(F.posexplode(F.array(*keys)).alias("choice", "value"), "*")
    sizes = keyed.groupBy("choice", "value").agg(F.count("*").alias("n"))
    # Written out, so that Spark knows how small it is when it picks the join.
    crowded = pin(
        sizes.where(F.col("n") > limit).select(
            "choice", "value", F.ceil(F.col("n") / F.lit(limit // 2)).cast("int").alias("cuts")
        ),
        "crowded",
    )
    cuts = F.coalesce("cuts", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), cuts).cast("int")
    other = F.sequence(F.lit(0), cuts - F.lit(1))
    cells = F.transform(
        other, lambda q: (F.least(own, q) * cuts + F.greatest(own, q)).cast("bigint")
    )
    lanes = [c for c in table.columns if c != "fp"]
    dealt = keyed.join(crowded, ["choice", "value"], "left").select(
        F.col("choice").cast("bigint").alias("choice"),
        "value",
        F.explode(cells).alias("cell"),
        "fp",
        *lanes,
    )
    group = ["choice", "value", "cell"]
    spread = dealt.repartition(partitions(nodes.sparkSession), *group)
    return map_batches(spread.sortWithinPartitions(*group), _link_groups(bits), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``.

    Equal fingerprints are one node however many documents share them. ``component_id``
    is the least ``doc_id`` that links reach; NULL ids count only where a component has
    no other, whose id is then NULL. NULL, empty and blank texts have fingerprint 0 and
    link like any other. Repeated rows each get a row.
    """
    prints = pin(fingerprints(docs, shingle), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    nodes = pin(nodes, "nodes")
    found = components(links(nodes.select("fp"), bits))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least_id"
    )
    rooted = pin(rooted, "rooted")
    # Written out as well, so that the join below reads its sides anew and Spark can split the
    # rows of a component that holds very many fingerprints.
    least = pin(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "least")
    labelled = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(labelled, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp"):
    """Sixteen lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), _WIDTH // 4, "0"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the least id.

    Of repeated rows of that id the least by all columns stays. Rows without an id
    stay, since nothing tells them apart.
    """
    labelled = near_duplicates(docs, shingle, bits)
    kept = labelled.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    rows = docs.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi")
    one = rows.groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return one.select("row.*").unionByName(docs.where(F.col("doc_id").isNull()))

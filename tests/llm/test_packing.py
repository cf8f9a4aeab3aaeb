import zlib
from array import array
from collections import Counter

import public_tokenizers
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing, queries, tokens

reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return reference.encode(text or "", add_special_tokens=False).ids


def check(rows, found):
    """Every id in one piece, pieces powers of two, sequences gapless and never shared."""
    lists = [(d, [*ids_of(t), 1]) for d, t in rows]
    wanted = Counter()
    for d, ids in lists:
        start = 0
        for length in packing.piece_lengths(len(ids)):
            part = array("I", ids[start : start + length]).tobytes()
            wanted[(d, start, length, zlib.crc32(part), len(ids))] += 1
            start += length
        assert start == len(ids)
    got = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found)
    assert got == wanted
    assert sorted(r.sequence_id for r in found) == list(range(len(found)))
    assert {r.offset for r in found} <= {0}
    in_order = [r.length for r in sorted(found, key=lambda r: r.sequence_id)]
    assert in_order == sorted(in_order, reverse=True)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check([tuple(r) for r in rows], queries.op6_packing(spark, SF).collect())


def test_odd_rows(odd_documents):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    check(rows, packing.packed_digest(odd_documents).collect())


def test_no_rows(no_documents):
    assert packing.packed_digest(no_documents).collect() == []


def test_ids_are_returned(documents):
    row = packing.pieces(documents([(1, "a tiny text")])).collect()
    ids = b"".join(bytes(r.ids) for r in sorted(row, key=lambda r: r.start))
    assert array("I", ids).tolist() == [*ids_of("a tiny text"), 1]


def test_lengths():
    for n in range(1, 6000, 7):
        lengths = packing.piece_lengths(n)
        assert sum(lengths) == n
        assert all(x & (x - 1) == 0 and x <= 2048 for x in lengths)
        assert len([x for x in lengths if x < 2048]) == (n % 2048).bit_count()


spaces = st.sampled_from([" ", "  ", "\n", "\t", " \n", " ", " ", "\x1c", "\x85", "\r\n", "​"])
bits = st.one_of(spaces, st.sampled_from(["a", "don't", "It's", "12", "x1y", "ñ", "日本", "🙂", "--", "'s", "'"]), st.text(max_size=3))


@settings(max_examples=400, deadline=None)
@given(st.lists(bits, max_size=12).map("".join))
def test_cached_pieces_equal_the_whole_text(text):
    got = array("I", tokens.encoder().packed(text)).tolist()
    assert got == ids_of(text)


literal = st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", "<|endoftext|><|endoftext|>"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(bits, literal), max_size=12).map("".join))
def test_added_tokens_equal_the_whole_text(text):
    got = array("I", tokens.encoder().packed(text)).tolist()
    assert got == ids_of(text)


def test_an_added_token_is_one_id(documents):
    assert array("I", tokens.encoder().packed("a <|endoftext|> b")).tolist() == [64, 220, 50256, 275]
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "x\n<|endoftext|>\n\n y <|endoftext|"), (4, None)]
    check(rows, packing.packed_digest(documents(rows)).collect())

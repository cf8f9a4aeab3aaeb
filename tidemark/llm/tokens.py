"""Token ids of whole texts from a public byte-level vocabulary, with a cache of words.

A split at a single blank or line break between two other characters is one that the
vocabulary's own pattern always makes, so the ids of a text are the ids of the pieces in
between, in a row. Natural text repeats its words, and a cached piece costs a dictionary
look-up.

Tokens that the vocabulary's JSON adds, such as ``<|endoftext|>``, are found first, as the
``tokenizers`` library does: each is one id, and the text between is encoded by itself.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from functools import lru_cache
from pathlib import Path

import public_tokenizers
import tiktoken

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_ID = 1  # closes every document

_SINGLE_GAP = re.compile(r"(?<=\S)([ \n])(?=\S)")
_CACHED_PIECES = 800_000
_CACHED_LENGTH = 40


class _OddSpace(Exception):
    """A piece that begins or ends with white space, or is empty."""


class _Pieces(dict):
    """Ids of ``lead + piece`` as little-endian 32-bit numbers.

    A piece that is not known is taken apart where its last letter or digit ends, which
    the vocabulary's pattern does as well; the marks that follow are few and soon known.
    """

    def __init__(self, encoding: tiktoken.Encoding, lead: str, tails: _Pieces | None = None):
        super().__init__()
        self._encode, self._lead, self._tails = encoding.encode_ordinary, lead, tails

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _OddSpace
        end = len(piece)
        if self._tails is not None:
            while end and not piece[end - 1].isalnum():
                end -= 1
        if 0 < end < len(piece) and not piece[end].isspace():
            ids = self[piece[:end]] + self._tails[piece[end:]]
        else:
            ids = _packed(self._encode(self._lead + piece))
        if len(piece) <= _CACHED_LENGTH:
            if len(self) >= _CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    return numbers.tobytes()


def added_tokens(vocabulary: str) -> dict[str, int]:
    """Ids of the tokens that the JSON beside the rank file adds to it; none without a JSON."""
    described = Path(vocabulary).with_suffix(".json")
    if not described.exists():
        return {}
    found = {}
    for token in json.loads(described.read_text(encoding="utf-8")).get("added_tokens") or []:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"added token {token['content']!r} takes its surroundings into account")
        found[token["content"]] = token["id"]
    return found


class TextEncoder:
    """Whole texts to packed ids; equal to encoding each text in one go."""

    def __init__(self, vocabulary: str = VOCABULARY):
        with open(vocabulary, "rb") as lines:
            ranks = {
                base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)
            }
        self._encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        tails = _Pieces(self._encoding, "")
        self._after_blank = _Pieces(self._encoding, " ", tails)
        self._after_break = _Pieces(self._encoding, "", tails)
        self._break = _packed(self._encoding.encode_ordinary("\n"))
        self._added = {token: _packed([i]) for token, i in added_tokens(vocabulary).items()}
        longest_first = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._any_added = re.compile(f"({'|'.join(longest_first)})") if longest_first else None

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers, without an end."""
        if not any(token in text for token in self._added):
            return self._plain(text)
        parts = self._any_added.split(text)
        return b"".join(self._added[p] if i % 2 else self._plain(p) for i, p in enumerate(parts))

    def _plain(self, text: str) -> bytes:
        try:
            return self._break.join(map(self._line, text.split("\n"))) if text else b""
        except _OddSpace:
            pass
        # Only gaps of one character between others are sure; the rest is encoded whole.
        first, *rest = _SINGLE_GAP.split(text)
        out = [_packed(self._encoding.encode_ordinary(first))]
        for gap, piece in zip(rest[::2], rest[1::2], strict=True):
            lead = " " if gap == " " else ""
            if not lead:
                out.append(self._break)
            out.append(_packed(self._encoding.encode_ordinary(lead + piece)))
        return b"".join(out)

    def _line(self, line: str) -> bytes:
        head, *rest = line.split(" ")
        return self._after_break[head] + b"".join(map(self._after_blank.__getitem__, rest))


@lru_cache(maxsize=4)
def encoder(vocabulary: str = VOCABULARY) -> TextEncoder:
    """One encoder per Python worker; its cache serves all tasks that the worker runs."""
    return TextEncoder(vocabulary)

"""All n-grams of a long run of bytes, numbered in order, without sorting positions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

# Bytes that occur in no UTF-8 text: before each text, and its end.
LEAD = 0xFE
END = 0xFF
_SLICE = 1 << 21
# Largest table of places; beyond it places are searched instead, with the same result.
_TABLE = 1 << 25


class _Places:
    """Ranks of the numbers that occur, among those that occur."""

    def __init__(self, size: int):
        self._marks = np.zeros(size, bool) if size <= _TABLE else None
        self._parts: list[np.ndarray] = []
        self._rank: np.ndarray | None = None
        self.present: np.ndarray | None = None

    def mark(self, numbers: np.ndarray) -> None:
        if self._marks is not None:
            self._marks[numbers] = True
        else:
            self._parts.append(np.unique(numbers))

    def close(self) -> None:
        if self._marks is not None:
            self.present = np.flatnonzero(self._marks)
            self._rank = np.cumsum(self._marks, dtype=np.int32)
            self._rank -= 1
            np.maximum(self._rank, 0, out=self._rank)
            self._marks = None
        else:
            self.present = np.unique(np.concatenate([*self._parts, np.empty(0, np.int64)]))
            self._parts = []

    def rank(self, numbers: np.ndarray) -> np.ndarray:
        if self._rank is not None:
            return self._rank[numbers]
        found = np.searchsorted(self.present, numbers)
        return np.minimum(found, max(len(self.present) - 1, 0)).astype(np.int32)


class ByteGrams:
    """The distinct runs of ``length`` bytes of ``data`` and which of them begins where.

    ``keys`` are sorted, the first byte highest; ``ids[i]`` is the place in it of the run that
    begins at ``i``. Runs that reach into the next text end with ``LEAD``, no others do. A run
    is numbered from the number of the run without its last byte and the number of its last
    three bytes, so tables stay near the number of runs that occur.
    """

    def __init__(self, data: np.ndarray, length: int):
        if length < 4:
            raise ValueError("runs of four bytes at least")
        seen = np.zeros(256, bool)
        seen[data] = True
        alphabet = np.flatnonzero(seen).astype(np.uint64)
        codes = (np.cumsum(seen) - 1).astype(np.uint8)[data]
        wide = len(alphabet)
        byte = np.uint64(8)
        keys = alphabet
        self.ids = codes.astype(np.int32)
        for at in (1, 2):
            by_pair = keys  # in the end, the runs of two bytes
            present = self._number(
                len(keys) * wide, at, lambda ids, s, e, at=at: ids * np.int64(wide) + codes[s + at : e + at]
            )
            firsts = np.searchsorted(present, np.arange(len(keys) + 1) * wide)
            keys = keys[present // wide] << byte | alphabet[present % wide]
        threes, triples = self.ids, keys
        for at in range(3, length):
            pair = np.searchsorted(by_pair, keys & np.uint64(0xFFFF))
            pair = np.minimum(pair, max(len(by_pair) - 1, 0))
            # The last pair of all may have nothing behind it.
            followed = by_pair[pair] == keys & np.uint64(0xFFFF)
            room = np.where(followed, firsts[pair + 1] - firsts[pair], 0)
            shift = np.cumsum(room) - room - firsts[pair]
            present = self._number(
                int(room.sum()),
                at,
                lambda ids, s, e, at=at, shift=shift: shift[ids] + threes[s + at - 2 : e + at - 2],
            )
            owner = np.repeat(np.arange(len(keys)), room)[present]
            last = triples[present - shift[owner]] & np.uint64(255)
            keys = keys[owner] << byte | last
        self.keys = keys

    def _number(self, size: int, at: int, numbers: Callable[..., np.ndarray]) -> np.ndarray:
        """Replace ids by the ranks of ``numbers`` of them; returns the numbers that occur."""
        before, n = self.ids, max(len(self.ids) - 1, 0)
        self.ids = np.empty(n, np.int32 if size < 1 << 31 else np.int64)
        places = _Places(size)
        for s in range(0, n, _SLICE):
            e = min(s + _SLICE, n)
            found = numbers(before[s:e], s, e)
            places.mark(found)
            self.ids[s:e] = found
        places.close()
        for s in range(0, n, _SLICE):
            self.ids[s : s + _SLICE] = places.rank(self.ids[s : s + _SLICE])
        return places.present

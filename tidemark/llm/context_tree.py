"""Context-tree weighting over bytes: the arithmetic, for sorted arrays of byte n-grams.

A byte is eight binary decisions; each decision, known by the bits before it in the byte, has
a context tree of its own over the bytes before. A node of it, a context of ``d`` bytes,
estimates its decision from its own counts (Krichevsky and Trofimov), and mixes that with the
estimates of its longer contexts, half and half before any data, by the probability that each
gave to the training data after it. So all depths take part everywhere, weighted per node.

A row is a context and the byte that follows, ``key = context << 8 | byte``, the latest byte
of the context in its highest place: a node's rows are neighbours, and cutting the lowest byte
of the context leads to its parent.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BITS = 8
_HALF = np.log(0.5)
# Below this, logarithms of the gamma function are summed, above it Stirling's series holds.
_EXACT = 1 << 12
_n = np.arange(_EXACT, dtype=np.float64)
_WHOLE = np.concatenate(([0.0], np.cumsum(np.log(_n[1:]))))
_HALVES = np.concatenate(([0.0], np.cumsum(np.log(_n[:-1] + 0.5))))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For large ``x``."""
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def _log_factorial(n: np.ndarray) -> np.ndarray:
    small = _WHOLE[np.minimum(n, _EXACT - 1).astype(np.int64)]
    return np.where(n < _EXACT, small, _log_gamma(np.maximum(n, _EXACT) + 1.0))


def _log_rising_half(n: np.ndarray) -> np.ndarray:
    """Logarithm of gamma(n + 1/2) / gamma(1/2)."""
    small = _HALVES[np.minimum(n, _EXACT - 1).astype(np.int64)]
    large = _log_gamma(np.maximum(n, _EXACT) + 0.5) - 0.5 * np.log(np.pi)
    return np.where(n < _EXACT, small, large)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_rising_half(zeros) + _log_rising_half(ones) - _log_factorial(zeros + ones)


@dataclass
class Decision:
    """One of the eight decisions at one depth: a node per context and bits before."""

    node: np.ndarray  # of each row
    first: np.ndarray  # row of each node
    bit: np.ndarray  # that each row's byte takes
    ones: np.ndarray
    total: np.ndarray
    own: np.ndarray  # log probability of the training data by the node's counts alone
    mixed: np.ndarray | None = None  # the same, mixed with longer contexts

    @staticmethod
    def of(keys: np.ndarray, counts: np.ndarray, k: int) -> Decision:
        nodes = keys >> np.uint64(BITS - k)
        new = np.concatenate(([True], nodes[1:] != nodes[:-1]))
        first = np.flatnonzero(new)
        bit = (keys >> np.uint64(BITS - 1 - k) & np.uint64(1)).astype(bool)
        total = np.add.reduceat(counts, first)
        ones = np.add.reduceat(counts * bit, first)
        own = log_estimate(total - ones, ones)
        return Decision(np.cumsum(new) - 1, first, bit, ones, total, own)

    def mix(self, longer: np.ndarray | None) -> None:
        """``longer`` sums the mixed values of each node's children; None at the deepest."""
        self.mixed = self.own if longer is None else np.logaddexp(self.own, longer) + _HALF

    def step(self, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of a one gathered down to these nodes, and the weight still open."""
        weight = np.exp(np.minimum(_HALF + self.own - self.mixed, 0.0))
        if self.mixed is self.own:
            weight = np.ones_like(weight)
        estimate = (self.ones + 0.5) / (self.total + 1.0)
        return lead + rest * weight * estimate, rest * (1.0 - weight)


@dataclass
class Level:
    """All rows of one depth."""

    keys: np.ndarray
    counts: np.ndarray
    decisions: list[Decision]
    up: np.ndarray | None = None  # row of the next shallower level, per row

    @staticmethod
    def of(keys: np.ndarray, counts: np.ndarray) -> Level:
        return Level(keys, counts, [Decision.of(keys, counts, k) for k in range(BITS)])

    def shallower(self) -> Level:
        parents = self.keys >> np.uint64(16) << np.uint64(8) | self.keys & np.uint64(255)
        keys, self.up = np.unique(parents, return_inverse=True)
        return Level.of(keys, np.bincount(self.up, self.counts, len(keys)))

    def above(self, k: int, parent: Level) -> np.ndarray:
        """The parent's node of each of this level's nodes."""
        return parent.decisions[k].node[self.up[self.decisions[k].first]]

    def sums_for(self, k: int, parent: Level) -> np.ndarray:
        nodes = len(parent.decisions[k].first)
        return np.bincount(self.above(k, parent), self.decisions[k].mixed, nodes)


def climb(keys: np.ndarray, counts: np.ndarray, levels: int, below: np.ndarray | None = None) -> list[Level]:
    """``levels`` levels from the deepest up, mixed but for the last one.

    ``below`` holds, per row and decision, the sums of still deeper levels for the rows' nodes;
    without it the rows are the deepest there are.
    """
    found = [Level.of(keys, counts.astype(np.float64))]
    for k, decision in enumerate(found[0].decisions):
        decision.mix(None if below is None else below[decision.first, k])
    while len(found) < levels:
        parent = found[-1].shallower()
        last = len(found) == levels - 1
        for k, decision in enumerate(parent.decisions):
            if not last or below is not None:
                decision.mix(found[-1].sums_for(k, parent))
        found.append(parent)
    return found


def passed_up(levels: list[Level]) -> np.ndarray:
    """Per row and decision of the shallowest level, the sums of the levels below it."""
    child, parent = levels[-2], levels[-1]
    out = np.empty((len(parent.keys), BITS))
    for k, decision in enumerate(parent.decisions):
        out[:, k] = child.sums_for(k, parent)[decision.node]
    return out


def hand_down(levels: list[Level], handed: np.ndarray | None) -> np.ndarray:
    """Per row of the deepest level, the ``lead`` and ``rest`` of its eight nodes.

    ``handed`` is the same for the rows of the shallowest level, which has then been stepped
    already; None where that level is the root.
    """
    out = np.empty((len(levels[0].keys), 2 * BITS))
    for k in range(BITS):
        shallow = levels[-1].decisions[k]
        if handed is None:
            nodes = len(shallow.first)
            lead, rest = shallow.step(np.zeros(nodes), np.ones(nodes))
        else:
            lead, rest = handed[shallow.first, k], handed[shallow.first, BITS + k]
        for child, parent in zip(reversed(levels[:-1]), reversed(levels[1:]), strict=True):
            at = child.above(k, parent)
            lead, rest = child.decisions[k].step(lead[at], rest[at])
        node = levels[0].decisions[k].node
        out[:, k], out[:, BITS + k] = lead[node], rest[node]
    return out


def log_probability(deepest: Level, handed: np.ndarray) -> np.ndarray:
    """Natural log probability of every row's byte after its context."""
    total = np.zeros(len(deepest.keys))
    for k, decision in enumerate(deepest.decisions):
        one = handed[:, k]
        total += np.log(np.where(decision.bit, one, 1.0 - one))
    return total

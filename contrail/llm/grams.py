"""Hashes of runs of words or bytes, and winnowed anchors, over the buffers of an Arrow batch.

Units are words or bytes, numbered through a chunk of whole texts. A run's hash is a polynomial of its units modulo
2^64 with an odd base, so that it follows from two prefix sums; it is scrambled before use.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

# Texts are worked on in chunks of about so many bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 21
# So many powers of a base are kept.
HELD_POWERS = 1 << 18

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASES = (np.uint64(0x9E3779B97F4A7C15 | 5), np.uint64(0xC2B2AE3D27D4EB4F | 5))


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(base: int, n: int) -> np.ndarray:
    return _held_powers(base)[:n] if n <= HELD_POWERS else _new_powers(base, n)


@cache
def _held_powers(base: int) -> np.ndarray:
    return _new_powers(base, HELD_POWERS)


def _new_powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Sums:
    """Prefix sums from which the hash of any run of units follows."""

    def __init__(self, units: np.ndarray, base: int = 0):
        one = int(_BASES[base])
        self.back = _powers(pow(one, -1, 1 << 64), len(units) + 1)
        self.total = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * _powers(one, len(units)), out=self.total[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the units from ``begin`` up to ``end``, which both may be slices or index arrays."""
        return scramble((self.total[end] - self.total[begin]) * self.back[begin])


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The UTF-8 bytes of whole texts, nulls as empty ones: number of the first text, bytes, and offsets of the texts
    (one more than texts)."""
    flat = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    whole = flat.buffers()[2]
    data = np.frombuffer(whole, np.uint8) if whole is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(flat):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(flat))
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word (a run without blanks, inside one text), and the word offsets of the texts."""
    solid = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], solid[:-1])) & ~edge[:-1] if len(data) else solid
    after = np.concatenate((solid[1:], [False])) & ~edge[1:] if len(data) else solid
    begin, end = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return begin, end, np.searchsorted(begin, offsets)


def word_units(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit number for every word."""
    return Sums(_BYTE[data]).of(begin, end)


def byte_units(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


@dataclass
class Anchors:
    """For every run of windows with the same anchor: the text it lies in, its first and last window start, counted
    from the beginning of the text, the anchor's hash, and a signature of all the units these windows hold."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    signature: np.ndarray


def anchors(units: np.ndarray, offsets: np.ndarray, window: int, gram: int, signed: bool = True) -> Anchors:
    """Winnowing: the anchor of a window of ``window`` units is its ``gram``-unit run with the smallest hash, the first
    of equal ones. Equal windows have equal anchors at equal places. Signatures are left out unless ``signed``."""
    none = np.empty(0, np.int64)
    n, grams = len(units), window - gram + 1
    if n < window:
        return Anchors(none, none, none, none, none)
    hashes = Sums(units).of(slice(0, n - gram + 1), slice(gram, n + 1))
    bits = np.uint64(max(1, int(n).bit_length()))
    lows = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= grams:
        lows = np.minimum(lows[:-width], lows[width:])
        width *= 2
    if grams > width:
        lows = np.minimum(lows[:width - grams], lows[grams - width:])
    # A window starts a run if its anchor lies elsewhere than the last one's, or if it is the first of a text.
    new = np.append(True, lows[1:] != lows[:-1])
    new[offsets[:-1][offsets[:-1] < len(new)]] = True
    first = np.flatnonzero(new)
    own = np.searchsorted(offsets, first, "right") - 1
    inside = first + window <= offsets[own + 1]
    first, own = first[inside], own[inside]
    if not len(first):
        return Anchors(none, none, none, none, none)
    # A run ends where the next begins, or with the last window of its text.
    last = np.minimum(np.append(first[1:], len(lows)) - 1, offsets[own + 1] - window)
    at = (lows[first] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    signature = none
    if signed:
        marks = Sums(scramble(units), 1)
        signature = scramble(marks.of(first, last + window) + (last - first).astype(np.uint64)
                             + ((at - first).astype(np.uint64) << np.uint64(32))).view(np.int64)
    return Anchors(own, first - offsets[own], last - offsets[own], hashes[at].view(np.int64), signature)


def window_hashes(sums: Sums, starts: np.ndarray, window: int) -> np.ndarray:
    return sums.of(starts, starts + window).view(np.int64)

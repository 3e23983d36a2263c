"""Rolling hashes and winnowed anchors of byte strings, vectorised.

A window of WINDOW bytes owns the k-gram in it with the smallest hash, the leftmost of equal ones; that k-gram's place is
the window's anchor. Equal windows own equal k-grams at equal distances, wherever they are, so windows need to be
compared only if their anchors' k-grams are equal. Windows that follow each other mostly share their anchor; a run is an
anchor with all its windows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

WINDOW = 200
GRAM = 64
PLACE_BITS = 24  # of a key that orders k-grams by hash, then place

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20240607).integers(0, 1 << 64, 256, dtype=np.uint64)


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, 1 << 21)
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = []
        for base in (_BASE, inverse):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers.append(np.cumprod(table))
    return _powers[0][: n + 1], _powers[1][: n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MULTIPLIER
    x = (x ^ (x >> np.uint64(29))) * _MULTIPLIER
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Hashes of all substrings of some bytes: a polynomial modulo 2**64 with random byte values, mixed."""

    def __init__(self, data: np.ndarray):
        self.forward, self.back = _power_tables(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_values()[data] * self.forward[:-1], out=self.sums[1:])

    def of(self, starts, ends) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])

    def grams(self, length: int) -> np.ndarray:
        return mix((self.sums[length:] - self.sums[:-length]) * self.back[: len(self.sums) - length])


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BLAKE2 digests of substrings, 128 bits in two halves; other than ``Hashes``, they tell any two strings apart."""
    view = memoryview(np.ascontiguousarray(data))
    raw = b"".join([hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist())])
    halves = np.frombuffer(raw, "<i8").reshape(-1, 2)
    return halves[:, 0], halves[:, 1]


@dataclass
class Runs:
    """Of each run: the first and last window start, the anchor and its k-gram's hash."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    gram: np.ndarray


def find_runs(data: np.ndarray, bounds: np.ndarray, hashes: Hashes) -> Runs:
    """Runs of all texts data[bounds[i]:bounds[i + 1]], in order; windows never cross texts."""
    none = np.zeros(0, np.int64)
    width = WINDOW - GRAM + 1
    if len(data) < WINDOW:
        return Runs(none, none, none, none.view(np.uint64))
    if len(data) >> PLACE_BITS:
        raise ValueError(f"cut texts into blocks of less than {1 << PLACE_BITS} bytes")
    mask = np.uint64((1 << PLACE_BITS) - 1)
    grams = hashes.grams(GRAM)
    keys = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    if size < width:
        keys = np.minimum(keys[: len(keys) - (width - size)], keys[width - size :])
    anchors = (keys & mask).astype(np.int64)
    inside = np.zeros(len(anchors) + 1, np.int64)
    low, high = bounds[:-1], bounds[1:] - WINDOW + 1
    some = high > low
    inside[low[some]] += 1
    inside[high[some]] -= 1
    places = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(places):
        return Runs(none, none, none, none.view(np.uint64))
    anchors = anchors[places]
    begins = np.concatenate(([True], anchors[1:] != anchors[:-1]))
    first = places[begins]
    last = places[np.concatenate((begins[1:], [True]))]
    anchor = anchors[begins]
    return Runs(first, last, anchor, grams[anchor])

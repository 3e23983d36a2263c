"""A run-length index of a repetitive text: matching statistics of every position against the rest of the text.

The suffix array is built by prefix doubling on those suffixes only that are not told apart yet. Its Burrows-Wheeler
transform is kept as runs, of which only the text positions at both ends are sampled; the array itself is not kept. Only
at a border of runs may the longest common prefix of neighbours be longer than what the position before tells (Kärkkäinen,
Manzini and Puglisi, 2009), so bytes are compared there and the lengths streamed on through the text from there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PACKED = 7  # bytes that the first sort compares


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the place of each suffix."""
    n = len(data)
    padded = np.zeros(n + PACKED, np.int64)
    padded[:n] = data.astype(np.int64) + 1
    key = np.zeros(n, np.int64)
    for j in range(PACKED):
        key = key * 257 + padded[j : j + n]
    order = np.argsort(key, kind="stable")
    slots, active, rank = np.arange(n), order, np.empty(n, np.int64)
    key = key[order]
    depth = PACKED
    while len(active):
        begins = np.concatenate(([True], key[1:] != key[:-1]))
        rank[active] = slots[np.maximum.accumulate(np.where(begins, np.arange(len(begins)), 0))]
        order[slots] = active
        alone = begins & np.concatenate((begins[1:], [True]))
        slots, active = slots[~alone], active[~alone]
        after = active + depth
        following = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + following
        sorting = np.argsort(key, kind="stable")
        active, key = active[sorting], key[sorting]
        depth *= 2
    return order, rank


@dataclass
class RunIndex:
    """The runs of the transform by their samples; a run's byte is the one before its samples."""

    starts: np.ndarray  # the text position at each run's first slot
    ends: np.ndarray    # the text position at each run's last slot


def build(data: np.ndarray) -> RunIndex:
    order, _ = suffix_array(data)
    before = np.where(order > 0, data[order - 1].astype(np.int16), -1)
    edges = np.flatnonzero(before[1:] != before[:-1])
    return RunIndex(order[np.concatenate(([0], edges + 1))], order[np.concatenate((edges, [len(data) - 1]))])


def common_prefixes(data: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Lengths of the longest common prefixes of pairs of suffixes."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = np.zeros(len(left), np.int64)
    going = np.arange(len(left))
    while len(going):
        a, b = left[going] + out[going], right[going] + out[going]
        room = n - np.maximum(a, b)
        same = words[np.minimum(a, n)] == words[np.minimum(b, n)]
        step = np.minimum(np.where(same.all(axis=1), 8, same.argmin(axis=1)), room)
        out[going] += step
        going = going[step == 8]
    return out


def _streamed(n: int, samples: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values by text position: known at the samples, and one less with each position after them."""
    known = np.full(n, -1, np.int64)
    known[samples] = values
    last = np.maximum.accumulate(np.where(known >= 0, np.arange(n), 0))
    return known[last] - (np.arange(n) - last)


def matching_statistics(data: np.ndarray) -> np.ndarray:
    """Of each position, the length of the longest string from it that also starts at another position.

    The longest match is with the suffix before or after it in order. Both are told by the borders of runs alone; the text's
    first position is a run by itself, so that a sample precedes every position.
    """
    n = len(data)
    if n < 2:
        return np.zeros(n, np.int64)
    index = build(data)
    borders = common_prefixes(data, index.ends[:-1], index.starts[1:])
    return np.maximum(
        _streamed(n, index.starts, np.concatenate(([0], borders))), _streamed(n, index.ends, np.concatenate((borders, [0])))
    )

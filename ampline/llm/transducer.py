"""A minimal acyclic automaton over byte words that numbers its words; the numbers lead to their token ids.

States with equal right languages are shared, so common suffixes are stored once. Every transition carries the
count of words that sort before its target's words, so the sum along a path is the word's rank. All of it lies in
one array of 64-bit integers that workers map into memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

HEADER = 6


def compile_words(words: list[bytes], ids: list[list[int]]) -> np.ndarray:
    """``words`` sorted and distinct; ``ids`` by word."""
    register: dict[tuple, int] = {}
    counts: list[int] = []
    states: list[tuple] = []
    path: list[list] = [[False, []]]  # open states from the root on: [final, [(byte, target), ...]]
    labels: list[int] = []

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, out = path.pop()
            key = (final, tuple(out))
            state = register.get(key)
            if state is None:
                state = register[key] = len(states)
                states.append(key)
                counts.append(final + sum(counts[t] for _, t in out))
            path[-1][1].append((labels.pop(), state))

    before = b""
    for word in words:
        shared = 0
        while shared < min(len(before), len(word)) and before[shared] == word[shared]:
            shared += 1
        close(shared)
        for byte in word[shared:]:
            labels.append(byte)
            path.append([False, []])
        path[-1][0] = True
        before = word
    close(0)
    root = len(states)
    states.append((path[0][0], tuple(path[0][1])))

    keys, targets, skips = [], [], []
    for state, (final, out) in enumerate(states):
        rank = int(final)
        for byte, target in out:
            keys.append(state << 8 | byte)
            targets.append(target)
            skips.append(rank)
            rank += counts[target]
    finals = [int(final) for final, _ in states]
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64)
    flat = np.array([x for y in ids for x in y], np.int64)
    header = [len(keys), len(states), len(words), len(flat), root, 0]
    return np.concatenate([np.array(x, np.int64) for x in (header, keys, targets, skips, finals, bounds, flat)])


class Transducer:
    def __init__(self, data: np.ndarray):
        n_keys, n_states, n_words, n_ids, self.root, _ = (int(x) for x in data[:HEADER])
        cuts = np.cumsum([HEADER, n_keys, n_keys, n_keys, n_states, n_words + 1, n_ids])
        self.keys, self.targets, self.skips, self.finals, self.bounds, self.ids = (
            data[a:b] for a, b in zip(cuts, cuts[1:])
        )

    def ranks(self, words: pa.Array) -> np.ndarray:
        """The rank of each word, -1 for words that are not in the lexicon; all words advance byte by byte."""
        starts = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        lengths = np.diff(starts)
        rank = np.full(len(words), -1, np.int64)
        alive = np.arange(len(words))
        state = np.full(len(words), self.root, np.int64)
        total = np.zeros(len(words), np.int64)
        depth = 0
        while len(alive):
            ended = lengths[alive] == depth
            done = alive[ended]
            good = self.finals[state[ended]] == 1
            rank[done[good]] = total[ended][good]
            alive, state, total = alive[~ended], state[~ended], total[~ended]
            if not len(alive) or not len(self.keys):
                break
            wanted = state << 8 | data[starts[alive] + depth]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            found = self.keys[at] == wanted
            alive, at = alive[found], at[found]
            state, total = self.targets[at], total[found] + self.skips[at]
            depth += 1
        return rank

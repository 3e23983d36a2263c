"""Words of a slice of texts as codes into the slice's distinct words, so that per-word work is done once."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO_WORDS = 200_000  # words whose ids a Python worker keeps; the first ones seen, which are mostly the frequent ones


@dataclass
class Words:
    codes: np.ndarray    # of all words, text after text
    bounds: np.ndarray   # text i has codes[bounds[i]:bounds[i + 1]]
    distinct: pa.Array   # the word of each code


def _coded(lists: pa.ListArray, drop_empty: bool) -> Words:
    flat = lists.flatten()
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    coded = flat.dictionary_encode()
    codes = np.asarray(coded.indices, dtype=np.int64)
    if drop_empty and len(flat):
        keep = np.asarray(pc.binary_length(flat)) > 0
        if not keep.all():
            before = np.concatenate(([0], np.cumsum(keep)))
            codes, offsets = codes[keep], before[offsets]
    return Words(codes, offsets, coded.dictionary)


def split_words(texts: pa.Array) -> Words:
    """Words between the ASCII white space characters (space and U+0009 to U+000D). An empty word may be in
    ``distinct`` but has no code in ``codes``."""
    return _coded(pc.ascii_split_whitespace(texts), drop_empty=True)


def split_spaces(texts: pa.Array) -> Words:
    """Pieces between single spaces, empty ones included."""
    return _coded(pc.split_pattern(texts, " "), drop_empty=False)


class Memo:
    """Token ids by piece, as bytes of little-endian unsigned 32-bit integers; bounded, and exact when full.

    ``encode_batch`` takes pieces and gives all their ids in one array and their number by piece. A process keeps one
    memo filled: another tokenizer's turn empties it.
    """

    filled: Memo | None = None

    def __init__(self, encode_batch, most: int = MEMO_WORDS):
        self.encode_batch, self.most, self.known = encode_batch, most, {}

    def __call__(self, pieces: list[str]) -> list[bytes]:
        if Memo.filled is not self:
            if Memo.filled:
                Memo.filled.known.clear()
            Memo.filled = self
        out = list(map(self.known.get, pieces))
        missing = [i for i, x in enumerate(out) if x is None]
        for low in range(0, len(missing), 20_000):
            part = missing[low : low + 20_000]
            ids, lengths = self.encode_batch([pieces[i] for i in part])
            data = ids.astype("<u4").tobytes()
            ends = (4 * np.cumsum(lengths)).tolist()
            for i, a, b in zip(part, [0, *ends], ends):
                out[i] = data[a:b]
            room = max(0, self.most - len(self.known))
            self.known.update((pieces[i], out[i]) for i in part[:room])
        return out


def flattened(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as one array and their lengths."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum())), lengths

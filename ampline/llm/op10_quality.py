"""Quality rules: base counts of words, lines and repeats, and tokeniser fertility.

Fertility is measured with a public vocabulary that has byte fallback: every distinct word is tokenised once per slice
of texts (or taken from a worker's memo), and a text's figures are sums over its words:

* chars_per_token: letters and digits by token, so that strings of marks count as tokens without characters,
* byte_share: share of tokens that are single bytes, for characters that the vocabulary lacks,
* token_entropy: entropy of the text's tokens in bits, divided by that of equally many distinct tokens (0 to 1).

A text is rejected where a figure leaves the band of its script. Figures of texts with fewer than ``min_tokens`` tokens
are not judged. Null and empty texts have zeros everywhere and fail the base rule; all columns pass through unchanged.
Repeated rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ampline.llm.common import documents, ragged, ship, string_column, text_slices, with_fields
from ampline.llm.tokenizer import public_path
from ampline.llm.words import Memo, flattened, split_words

TOKENIZER = "piece_bpe_32k.model"
SYMBOLS = r"[#*$%&|<>]"
SCRIPTS = ("latin", "greek", "cyrillic", "arabic", "han", "other")
#: Last code point of each range of letters and the script's place in SCRIPTS; a coarse fixed table.
SCRIPT_RANGES = ((0x24F, 0), (0x36F, 5), (0x3FF, 1), (0x52F, 2), (0x5FF, 5), (0x6FF, 3), (0x2FFF, 5), (0x9FFF, 4), (0x10FFFF, 5))


@dataclass(frozen=True)
class Band:
    """A text is kept while its figures lie within these limits, ends included."""

    chars_per_token: tuple[float, float]
    byte_share: tuple[float, float]
    token_entropy: tuple[float, float]


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_tokens: int = 50
    bands: dict[str, Band] = field(default_factory=lambda: {
        "latin": Band((1.40, 12.0), (0.0, 0.10), (0.40, 1.0)),
        "greek": Band((0.60, 12.0), (0.0, 0.60), (0.35, 1.0)),
        "cyrillic": Band((0.90, 12.0), (0.0, 0.30), (0.45, 1.0)),
        "arabic": Band((0.60, 12.0), (0.0, 0.60), (0.35, 1.0)),
        "han": Band((0.25, 4.0), (0.0, 0.95), (0.25, 1.0)),
        "other": Band((0.20, 12.0), (0.0, 1.0), (0.20, 1.0)),
    })


@lru_cache(maxsize=2)
def _memo(path: str) -> tuple[Memo, np.ndarray]:
    """Ids by word, and which ids are single bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    single = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
    return Memo(lambda words: flattened(model.encode(words, num_threads=1))), single


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(values)))[bounds])


def _repeat_words(codes: np.ndarray, bounds: np.ndarray, n_distinct: int) -> np.ndarray:
    """By text, the words inside windows of three words that the text has twice or more."""
    if len(codes) < 3:
        return np.zeros(len(bounds) - 1, np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    pairs = np.unique(codes[:-1] * n_distinct + codes[1:], return_inverse=True)[1]
    inside = np.flatnonzero(text[:-2] == text[2:])
    window = pairs[inside] * n_distinct + codes[inside + 2]
    order = np.argsort(window, kind="stable")  # texts stay in order within equal windows
    window, owner = window[order], text[inside][order]
    same = (window[1:] == window[:-1]) & (owner[1:] == owner[:-1])
    often = np.concatenate((same, [False])) | np.concatenate(([False], same))
    covered = np.zeros(len(codes), bool)
    at = inside[order[often]]
    for step in range(3):
        covered[at + step] = True
    return _sums(covered, bounds)


def _dup_lines(texts: pa.Array) -> np.ndarray:
    """By text, the lines with a word that equal an earlier line."""
    out = np.zeros(len(texts), np.int64)
    lists = pc.split_pattern(texts, "\n")
    offsets = np.asarray(lists.offsets, np.int64) - lists.offsets[0].as_py()
    lines = lists.flatten()
    line_words = split_words(lines)
    filled = np.diff(line_words.bounds) > 0
    codes = np.asarray(lines.dictionary_encode().indices, np.int64)[filled]
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))[filled]
    if len(codes):
        key = owner * (codes.max() + 1) + codes
        n, distinct = np.bincount(owner, minlength=len(texts)), np.unique(key)
        out = n - np.bincount(distinct // (codes.max() + 1), minlength=len(texts))
    return out


def _entropies(codes: np.ndarray, bounds: np.ndarray, word_ids: np.ndarray, sizes: np.ndarray, vocabulary: int) -> np.ndarray:
    """Entropy of each text's tokens over the largest for as many tokens; 0 for fewer than two tokens."""
    n_texts = len(bounds) - 1
    text = np.repeat(np.arange(n_texts), np.diff(bounds))
    keys, counts = np.unique(text * len(sizes) + codes, return_counts=True)  # words first: fewer tokens to sort
    text, word = np.divmod(keys, len(sizes))
    each = sizes[word]
    tokens = word_ids[ragged((np.cumsum(sizes) - sizes)[word], each)]
    keys, place = np.unique(np.repeat(text, each) * vocabulary + tokens, return_inverse=True)
    counts = np.bincount(place, weights=np.repeat(counts, each), minlength=len(keys))
    text = keys // vocabulary
    total = np.bincount(text, weights=counts, minlength=n_texts)
    spread = np.bincount(text, weights=counts * np.log2(counts), minlength=n_texts)
    safe = np.maximum(total, 2)
    return np.where(total >= 2, np.clip(1 - spread / safe / np.log2(safe), 0, 1), 0.0)


def _scripts(words: list[str], counts: np.ndarray) -> np.ndarray:
    """By word, the script of its first letter beyond ASCII, or of its first letter; latin without letters."""
    ends = np.array([end for end, _ in SCRIPT_RANGES])
    kinds = np.array([kind for _, kind in SCRIPT_RANGES])
    out = np.zeros(len(words), np.int64)
    for i, word in enumerate(words):
        if not word.isascii():
            out[i] = kinds[np.searchsorted(ends, next((ord(c) for c in word if ord(c) > 127 and c.isalpha()), 0))]
    return out


def measure(texts: pa.Array, path: str) -> dict[str, np.ndarray]:
    """All figures of a slice of texts."""
    words = split_words(texts)
    codes, bounds = words.codes, words.bounds
    memo, single = _memo(path)
    spelled = words.distinct.to_pylist()
    ids = memo(spelled)
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
    n_bytes = _sums(single[flat], np.concatenate(([0], np.cumsum(sizes))))
    chars = np.asarray(pc.utf8_length(words.distinct), np.int64)
    letters = np.asarray(pc.count_substring_regex(words.distinct, r"[\pL\pM\pN]"), np.int64)
    word_chars, n_tokens = _sums(chars[codes], bounds), _sums(sizes[codes], bounds)
    scripts = _scripts(spelled, chars)
    by_script = np.stack([_sums(np.where(scripts[codes] == k, chars[codes], 0), bounds) for k in range(len(SCRIPTS))])
    by_script[0] //= 4  # words of other scripts outweigh Latin ones among them
    return {
        "n_words": np.diff(bounds),
        "word_chars": word_chars,
        "n_symbols": np.asarray(pc.count_substring_regex(texts, SYMBOLS), np.int64),
        "n_dup_lines": _dup_lines(texts),
        "n_repeat_words": _repeat_words(codes, bounds, max(1, len(words.distinct))),
        "n_tokens": n_tokens,
        "chars_per_token": _sums(letters[codes], bounds) / np.maximum(n_tokens, 1),
        "byte_share": _sums(n_bytes[codes], bounds) / np.maximum(n_tokens, 1),
        "token_entropy": _entropies(codes, bounds, flat, sizes, len(single)) if len(codes) else np.zeros(len(texts)),
        "script": by_script.argmax(axis=0),
    }


def judge(figures: dict[str, np.ndarray], rules: Rules) -> None:
    """Add base_failed and kept."""
    n_words = figures["n_words"]
    figures["base_failed"] = (n_words < rules.min_words) | (
        100 * figures["n_repeat_words"] > rules.max_repeat_percent * n_words
    )
    inside = np.ones(len(n_words), bool)
    for name in ("chars_per_token", "byte_share", "token_entropy"):
        limits = np.array([getattr(rules.bands[s], name) for s in SCRIPTS])[figures["script"]]
        inside &= (figures[name] >= limits[:, 0]) & (figures[name] <= limits[:, 1])
    figures["kept"] = ~figures["base_failed"] & (inside | (figures["n_tokens"] < rules.min_tokens))


RESULT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, "
    "kept boolean, n_tokens bigint, chars_per_token double, byte_share double, token_entropy double, script string"
)


def quality_report(docs: DataFrame, path: str, rules: Rules = Rules()) -> DataFrame:
    """doc_id and the figures and verdict of every row."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            figures = measure(string_column(batch.column(1)), path)
            judge(figures, rules)
            figures["script"] = pa.array(SCRIPTS).take(pa.array(figures["script"]))
            names = [x.split()[0] for x in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(figures[n]) for n in names]], names=["doc_id", *names])

    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(report, with_fields(docs.select("doc_id"), RESULT))


def keep_good(docs: DataFrame, path: str, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            figures = measure(string_column(batch.column(place)), path)
            judge(figures, rules)
            yield batch.filter(pa.array(figures["kept"]))

    ship(docs.sparkSession)
    return docs.mapInArrow(keep, docs.schema)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(documents(spark, sf_dir), public_path(TOKENIZER))

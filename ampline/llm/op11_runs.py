"""Periodic runs of words, found by multi-scale minimizers.

A run is a longest stretch of words in which words ``period`` apart are equal, with its smallest period and at least
``least_words`` words and ``least_exponent`` periods.

* Scale 2**k looks for periods from 2**k to 2**(k+1)-1. Every stretch of 2**(k+1) words has a number, equal for equal
  stretches: those of a scale are numbered from pairs of the scale before, so no hash decides about equality. Of all
  windows of 2**k neighbouring stretches, those with the smallest (scrambled) number are the window's minimizers.
* Inside a run, minimizers repeat a period apart, and no equal stretch lies in between, as a stretch that is longer than
  the period occurs once per period. So neighbouring equal minimizers, two to three per window, seed all runs of the
  scale: a seed's words are compared with those a period later, forwards and backwards, until they differ. Seeds inside
  an extended stretch are passed over, so the work grows with the length of the text.
* Periods below FIRST_SCALE are too short for windows: the words are compared at each of these lags directly.

A stretch whose words have several periods is found with each; the smallest counts.

All rows are handled in one pass without a shuffle, in slices of about RUN_BYTES of text; a longer text is a slice by
itself. Null and empty texts have no words, no runs and an empty collapsed text. Rows with equal ids are handled one by
one; all columns of ``docs`` but those of the result are left out, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ampline.llm.common import documents, quoted, ragged, ship, string_column, text_slices, with_fields
from ampline.llm.windows import mix
from ampline.llm.words import split_words

LEAST_WORDS = 6
LEAST_EXPONENT = 4
FIRST_SCALE = 8
RUN_BYTES = 2 << 20  # of text in a slice; a word takes some 200 bytes while its slice is searched
RESULT = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _lag_stretches(codes: np.ndarray, text: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end of the longest stretches of at least ``least`` words with words ``lag`` apart equal."""
    none = np.zeros(0, np.int64)
    if len(codes) <= lag:
        return none, none
    equal = (codes[lag:] == codes[:-lag]) & (text[lag:] == text[:-lag])
    edges = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False])).astype(np.int8)))
    first, end = edges[::2], edges[1::2] + lag
    long = end - first >= least
    return first[long], end[long]


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """Of each ``size`` neighbours (a power of two) the one that ``pick`` (np.minimum or np.maximum) chooses."""
    step = 1
    while step < size:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def _minimizers(numbers: np.ndarray, valid: np.ndarray, width: int) -> np.ndarray:
    """Places that are a smallest number of some window of ``width`` valid places; all places of equal numbers count."""
    top = np.uint64(np.iinfo(np.uint64).max)
    order = np.where(valid, mix(numbers.astype(np.uint64) + np.uint64(1)) >> np.uint64(1), top)
    smallest = _sliding(order, width, np.minimum)
    padded = np.concatenate((np.zeros(width - 1, np.uint64), smallest, np.zeros(width - 1, np.uint64)))
    return np.flatnonzero(valid & (_sliding(padded, width, np.maximum) == order))


def _seeds(numbers: np.ndarray, text: np.ndarray, places: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and distance of neighbouring equal minimizers whose distance is a period of the scale, by distance and place."""
    held = numbers[places]
    order = np.argsort(held, kind="stable")  # places stay in order within equal numbers
    at, held = places[order], held[order]
    distance = at[1:] - at[:-1]
    good = (held[1:] == held[:-1]) & (text[at[1:]] == text[at[:-1]]) & (distance >= scale) & (distance < 2 * scale)
    at, distance = at[:-1][good], distance[good]
    order = np.lexsort((at, distance))
    return at[order], distance[order]


def _equal_ahead(codes: np.ndarray, a: int, b: int, end: int) -> int:
    """Number of equal words from a and b > a on, before ``end``."""
    n, step = 0, 256
    while b + n < end:
        size = min(step, end - b - n)
        differ = codes[a + n : a + n + size] != codes[b + n : b + n + size]
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + size, step * 2
    return n


def _equal_behind(codes: np.ndarray, a: int, b: int, start: int) -> int:
    """Number of equal words that end before a and b > a, not before ``start``."""
    n, step = 0, 256
    while a - n > start:
        size = min(step, a - n - start)
        differ = codes[a - n - size : a - n] != codes[b - n - size : b - n]
        if differ.any():
            return n + int(differ[::-1].argmax())
        n, step = n + size, step * 2
    return n


def _extended(codes: np.ndarray, bounds: np.ndarray, text: np.ndarray, at: np.ndarray, distance: np.ndarray) -> list:
    """first, end and period of the stretches around the seeds."""
    found, last = [], (0, -1)  # period and end of the stretch before
    for place, period in zip(at.tolist(), distance.tolist()):
        if last[0] == period and place + period < last[1]:
            continue
        start, end = int(bounds[text[place]]), int(bounds[text[place] + 1])
        first = place - _equal_behind(codes, place, place + period, start)
        stop = place + period + _equal_ahead(codes, place, place + period, end)
        last = (period, stop)
        found.append((first, stop, period))
    return found


def find_runs(
    codes: np.ndarray, bounds: np.ndarray, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT
) -> np.ndarray:
    """Runs of all texts codes[bounds[i]:bounds[i + 1]] as rows (text, start, length, period), by start, then period."""
    if least_exponent < 4:
        raise ValueError("runs of fewer than four periods may hold no two equal minimizers")
    n_texts, codes = len(bounds) - 1, codes.astype(np.int64)
    text = np.repeat(np.arange(n_texts), np.diff(bounds))
    found = []
    for period in range(1, FIRST_SCALE):
        first, end = _lag_stretches(codes, text, period, max(least_words, least_exponent * period))
        found.append(np.stack((first, end, np.full(len(first), period)), axis=1))
    # Texts long enough for the scale, one after the other; ``numbers`` are those of stretches of ``scale`` words.
    scale, part, lengths, numbers = 1, np.arange(n_texts), np.diff(bounds), codes
    while True:
        long = lengths >= least_exponent * max(scale, FIRST_SCALE)
        if not long.any():
            break
        if not long.all():
            keep = ragged((np.cumsum(lengths) - lengths)[long], lengths[long])
            part, lengths, numbers = part[long], lengths[long], numbers[keep]
        own = np.repeat(np.arange(len(part)), lengths)
        room = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(numbers))  # words from here to the text's end
        # A stretch of 2 * scale words is a pair of two; the numbers stay below the number of words.
        valid = room >= 2 * scale
        pairs = np.full(len(numbers), -1, np.int64)
        at = np.flatnonzero(valid)
        pairs[at] = numbers[at] * (int(numbers.max()) + 1) + numbers[at + scale]
        numbers = pd.factorize(pairs)[0].astype(np.int64)
        if scale >= FIRST_SCALE:
            here = codes[ragged(bounds[part], lengths)]
            inner = np.concatenate(([0], np.cumsum(lengths)))
            seeds = _seeds(numbers, own, _minimizers(numbers, valid, scale), scale)
            rows = _extended(here, inner, own, *seeds)
            if rows:
                rows = np.array(rows, np.int64)
                rows = rows[rows[:, 1] - rows[:, 0] >= np.maximum(least_words, least_exponent * rows[:, 2])]
                shift = bounds[part[own[rows[:, 0]]]] - inner[own[rows[:, 0]]] if len(rows) else 0
                rows[:, 0] += shift
                rows[:, 1] += shift
                found.append(rows)
        scale *= 2
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    smallest = np.ones(len(rows), bool)  # a stretch that has several periods is found with each of them
    smallest[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
    rows = rows[smallest]
    owner = text[rows[:, 0]] if len(rows) else rows[:, 0]
    out = np.stack((owner, rows[:, 0] - bounds[owner], rows[:, 1] - rows[:, 0], rows[:, 2]), axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _collapsed(codes: np.ndarray, bounds: np.ndarray, distinct: pa.Array, runs: np.ndarray) -> pa.Array:
    """The texts' words without those that a run covers behind its first period, joined by one space."""
    change = np.zeros(len(codes) + 1, np.int64)
    begin = bounds[runs[:, 0]] + runs[:, 1]
    np.add.at(change, begin + runs[:, 3], 1)
    np.add.at(change, begin + runs[:, 2], -1)
    keep = np.cumsum(change[:-1]) == 0
    offsets = np.concatenate(([0], np.cumsum(keep)))[bounds]
    words = distinct.take(pa.array(codes[keep]))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words), " ")


def collapse_runs(docs: DataFrame, keys: list[str], least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """``keys`` of every row, its number of words, its runs (by start, then period) and the text without repeats.

    ``keys`` must not hold a column named n_words, runs or collapsed.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, most=RUN_BYTES):
            words = split_words(string_column(batch.column(len(keys))))
            bounds = np.asarray(words.bounds, np.int64)
            runs = find_runs(words.codes, bounds, least_words, least_exponent)
            offsets = np.searchsorted(runs[:, 0], np.arange(batch.num_rows + 1))
            fields = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(keys))], pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields),
                    _collapsed(words.codes, bounds, words.distinct, runs),
                ],
                names=[*keys, "n_words", "runs", "collapsed"],
            )

    ship(docs.sparkSession)
    rows = docs.select(*map(quoted, keys), "text")
    return rows.mapInArrow(work, with_fields(rows.drop("text"), RESULT))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the words of a tenth of the documents repeat from some word on, as the query demands.

    Rows without an id or without words stay as they are.
    """
    h = "crc32(cast(cast(doc_id as string) as binary))"
    chosen = docs.selectExpr("doc_id", "text", f"{h} as h").selectExpr(
        "doc_id", "text", "h div 10 as g",
        r"if(h % 10 = 0, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0), null) as words",
    )
    placed = chosen.selectExpr("*", "size(words) as n").selectExpr("*", "if(n > 0, cast(g % n as int), 0) as a").selectExpr(
        "doc_id", "text", "words", "n", "a", "cast(1 + (n - a) div (3 + g % 8) as int) as p"
    )
    copies = "array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) as int))"
    planted = f"array_join(concat(slice(words, 1, a), slice(flatten({copies}), 1, n - a)), ' ')"
    return placed.selectExpr("doc_id", f"if(n > 0, {planted}, text) as text")


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(with_planted_runs(documents(spark, sf_dir)), ["doc_id"])
    # The greatest length / period, compared as products; the first of equal ones, as runs are in order.
    best = (
        "aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), "
        "(b, r) -> if(b is null or r.length * b.period > b.length * r.period, r, b))"
    )
    lines = "array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'), '')"
    return found.selectExpr("*", f"{best} as best").selectExpr(
        "doc_id", "cast(size(runs) as bigint) as n_runs", "best.start as start", "best.length as length", "best.period as period",
        "1000 * best.length div best.period as exponent_milli",
        f"sha2({lines}, 256) as runs_sha256", "sha2(collapsed, 256) as collapsed_sha256",
    )

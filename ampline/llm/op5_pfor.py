"""Token ids in binary files: patched frame-of-reference blocks.

A file is a Parquet table of segments. A segment holds whole documents, at least one and else about SEGMENT_IDS ids, in
one payload of blocks of BLOCK_IDS ids. A block stores its minimum, the differences to it packed at the width that
WIDTH_SHARE of them fit into, and the positions and values of the others as exceptions; ``block_starts`` has the byte
at which each block begins, so that a reader can go to any id without unpacking those before it. Segments are written
in ascending order of document id; ``part`` and ``first`` (ids before the segment in its part) place them.

Every task writes its own part, so a lost one is written again alone. Null texts count as empty and have the end id
only. Null document ids come first; rows with equal ids follow one another, ordered by their text's hash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ampline.llm.common import documents, ragged, ship, string_column, text_slices
from ampline.llm.tokenizer import open_tokenizer, public_path
from ampline.llm.words import Memo, flattened, split_words
from ampline.staging import stage

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
BLOCK_IDS = 1024
SEGMENT_IDS = 1 << 16
WIDTH_SHARE = 0.9
HEADER = np.dtype([("low", "<u4"), ("width", "u1"), ("n", "<u2"), ("n_exceptions", "<u2")])
SEGMENTS = (
    "part int, seq int, first bigint, doc_ids array<bigint>, n_tokens array<int>, block_starts array<int>, payload binary"
)


# ---- blocks -------------------------------------------------------------------------------------------------------


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK_IDS values below 2**width as rows of bytes; 64 values share ``width`` 64-bit words."""
    lanes = values.reshape(-1, 64)
    words = np.zeros((len(lanes), width), np.uint64)
    for j in range(64 if width else 0):
        word, shift = divmod(j * width, 64)
        words[:, word] |= lanes[:, j] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= lanes[:, j] >> np.uint64(64 - shift)
    return words.astype("<u8").reshape(len(values), -1).view(np.uint8)


def _unpack(data: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(data).view("<u8").astype(np.uint64).reshape(-1, width)
    lanes = np.empty((len(words), 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        lane = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            lane = lane | words[:, word + 1] << np.uint64(64 - shift)
        lanes[:, j] = lane & mask
    return lanes.reshape(len(data), BLOCK_IDS)


def pack_ids(ids: np.ndarray) -> tuple[list[int], bytes]:
    """Block starts and payload of a segment's ids (unsigned 32 bits)."""
    n_blocks = -(-len(ids) // BLOCK_IDS)
    if not n_blocks:
        return [], b""
    padded = np.full(n_blocks * BLOCK_IDS, ids[-1], np.uint64)  # a copy of the last id widens no block
    padded[: len(ids)] = ids
    blocks = padded.reshape(n_blocks, BLOCK_IDS)
    low = blocks.min(axis=1)
    rest = blocks - low[:, None]
    at = int(np.ceil(BLOCK_IDS * WIDTH_SHARE)) - 1
    widths = np.array([int(x).bit_length() for x in np.partition(rest, at, axis=1)[:, at]])
    limit = np.uint64(1) << widths.astype(np.uint64)
    outside = rest >= limit[:, None]
    counts = np.minimum(BLOCK_IDS, len(ids) - np.arange(n_blocks) * BLOCK_IDS)
    parts: list[bytes] = [b""] * n_blocks
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        packed = _pack(np.where(outside[rows], np.uint64(0), rest[rows]), int(width))
        for row, data in zip(rows, packed):
            places = np.flatnonzero(outside[row])
            header = np.array([(low[row], width, counts[row], len(places))], HEADER)
            parts[row] = (
                header.tobytes() + data.tobytes() + places.astype("<u2").tobytes() + rest[row][places].astype("<u4").tobytes()
            )
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))[:-1].tolist()
    return starts, b"".join(parts)


def unpack_ids(starts: list[int], payload: bytes) -> np.ndarray:
    """The ids of a segment, or of some of its blocks."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    data = np.frombuffer(payload, np.uint8)
    heads = np.concatenate([np.frombuffer(payload, HEADER, 1, s) for s in starts])
    rest = np.zeros((len(starts), BLOCK_IDS), np.uint64)
    bodies = np.asarray(starts, np.int64) + HEADER.itemsize
    for width in np.unique(heads["width"]):
        rows = np.flatnonzero(heads["width"] == width)
        if width:
            size = BLOCK_IDS // 8 * int(width)
            rest[rows] = _unpack(data[bodies[rows][:, None] + np.arange(size)], int(width))
    for row in np.flatnonzero(heads["n_exceptions"]):
        n = int(heads["n_exceptions"][row])
        at = int(bodies[row]) + BLOCK_IDS // 8 * int(heads["width"][row])
        rest[row, np.frombuffer(payload, "<u2", n, at)] = np.frombuffer(payload, "<u4", n, at + 2 * n)
    ids = (rest + heads["low"].astype(np.uint64)[:, None]).astype(np.uint32)
    return ids[np.arange(BLOCK_IDS) < heads["n"][:, None]]


# ---- encoding -----------------------------------------------------------------------------------------------------

PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+([.,;:!?*#$%&|<>()-]*)")
JOINED = 128


def word_encoder(path: str):
    """A function from words to all their ids and their number by word. Words of letters and closing marks only, which the tokenizer cuts into one or two parts, are sent
    many in one text, as each part's last token is marked as such; other words are sent one by one."""
    tokenizer = open_tokenizer(path)
    closing = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), bool)
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        closing[i] = token.endswith("</w>")

    def alone(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flattened([e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)])

    def together(words: list[str], parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        chunks = ["\n".join(words[a : a + JOINED]) for a in range(0, len(words), JOINED)]
        ids, sizes = alone(chunks)
        ends = np.flatnonzero(closing[ids]) + 1
        begins = np.arange(0, len(words), JOINED)
        if not np.array_equal(np.searchsorted(ends, np.cumsum(sizes), "right"), np.cumsum(np.add.reduceat(parts, begins))):
            return alone(words)  # a part without a marked end
        ends = ends[np.cumsum(parts) - 1]
        return ids, np.diff(ends, prepend=0)

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [PLAIN.fullmatch(w) for w in words]
        plain = np.array([m is not None for m in found], bool)
        joined = [w for w, m in zip(words, found) if m]
        others = [w for w, m in zip(words, found) if not m]
        parts = np.array([1 + (m.end() > m.start(1)) for m in found if m], np.int64)
        lengths = np.zeros(len(words), np.int64)
        first, lengths[plain] = together(joined, parts) if joined else flattened([])
        second, lengths[~plain] = alone(others)
        ids, starts = np.empty(int(lengths.sum()), np.uint32), np.cumsum(lengths) - lengths
        ids[ragged(starts[plain], lengths[plain])] = first
        ids[ragged(starts[~plain], lengths[~plain])] = second
        return ids, lengths

    return encode


@lru_cache(maxsize=2)
def _memo(path: str) -> Memo:
    return Memo(word_encoder(path), most=600_000)


def encode_texts(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in order, each with the end id, and the number of ids by text."""
    words = split_words(texts)
    spelled = _memo(path)(words.distinct.to_pylist())
    lengths = np.array([*map(len, spelled), 4], np.int64) // 4
    flat = np.concatenate([np.frombuffer(b"".join(spelled), "<u4"), np.array([end_id], "<u4")])
    codes = np.insert(words.codes, words.bounds[1:], len(spelled))
    size = lengths[codes]
    ids = flat[ragged((np.cumsum(lengths) - lengths)[codes], size)]
    ends = np.cumsum(size)[words.bounds[1:] + np.arange(len(texts))]
    return ids, np.diff(ends, prepend=0)


# ---- files --------------------------------------------------------------------------------------------------------


def segments(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """The segments of all documents, in ascending order of doc_id over and within parts."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        for batch in text_slices(batches):
            doc_ids = batch.column(0).to_pylist()
            ids, sizes = encode_texts(string_column(batch.column(1)), path, end_id)
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            low, rows = 0, []
            while low < len(doc_ids):
                high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + SEGMENT_IDS, "right")) - 1)
                starts, payload = pack_ids(ids[bounds[low] : bounds[high]])
                rows.append((part, seq, first, doc_ids[low:high], sizes[low:high].tolist(), starts, payload))
                seq, first, low = seq + 1, first + int(bounds[high] - bounds[low]), high
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
            names = ["part", "seq", "first", "doc_ids", "n_tokens", "block_starts", "payload"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)

    ship(docs.sparkSession)
    order = [F.col("doc_id"), F.xxhash64("text")]
    placed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")).repartitionByRange(*order)
    return placed.sortWithinPartitions(*order).mapInArrow(write, SEGMENTS)


def read_documents(files: DataFrame) -> DataFrame:
    """Unpack every segment: doc_id, start, n_tokens and ids_crc32 by document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_ids(row["block_starts"], row["payload"]).astype("<u4")
                sizes = np.array(row["n_tokens"], np.int64)
                bounds = np.concatenate(([0], np.cumsum(sizes))).tolist()
                checks = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(sizes), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                        pa.array([row["first"] + b for b in bounds[:-1]], pa.int64()), pa.array(sizes), pa.array(checks, pa.int64()),
                    ],
                    names=["part", "doc_id", "place", "n_tokens", "ids_crc32"],
                )

    sizes = files.select("part", F.expr("aggregate(n_tokens, 0L, (a, n) -> a + n)").alias("n"))
    totals = sizes.groupBy("part").agg(F.sum("n").alias("n"))  # one row per part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = files.mapInArrow(read, "part int, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(bases, "part").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def op5_pfor(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = stage(segments(documents(spark, sf_dir), public_path(TOKENIZER)), "token-files")
    return read_documents(files)

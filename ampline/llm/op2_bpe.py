"""Byte-level BPE of whole texts with a lexicon transducer, and back.

The lexicon holds the most frequent space-led pieces of the corpus with their ids, compiled into a minimal acyclic
automaton that every worker maps into memory. Pieces above PIECE_BYTES are never in it, so that at most LEXICON_WORDS *
PIECE_BYTES bytes (4 MB) reach the driver, whatever the corpus has between its spaces. Pieces outside it are merged by the tokenizer itself, once per worker
while its memo has room. A text is cut before a space only where the tokenizer's own word splitting is sure to cut;
texts with other white space patterns or special tokens are encoded whole by the tokenizer.

Null texts count as empty: no ids, empty decoded text. Rows are never merged: repeated ids give repeated rows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampline.llm.common import documents, ragged, ship, string_column, text_slices, with_fields
from ampline.llm.tokenizer import id_lists, open_tokenizer, public_path
from ampline.llm.transducer import Transducer, compile_words
from ampline.llm.words import Memo, Words, flattened, split_spaces
from ampline.staging import stage

TOKENIZER = "byte_bpe_50k.json"
LEXICON_WORDS = 1 << 16  # capacity of the lexicon; it changes the speed, never the ids
PIECE_BYTES = 64         # of a piece of the lexicon, at most; alike
SPECIAL = "<|endoftext|>"
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNSURE = SPACE + " (" + SPACE + r"|\z)"


def _pieces(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, Words, np.ndarray]:
    """Texts, which of them are encoded whole, their pieces, and the place of each text's first piece."""
    texts = string_column(batch.column(batch.schema.get_field_index("text")))
    whole = pc.or_(pc.match_substring_regex(texts, UNSURE), pc.match_substring(texts, SPECIAL))
    whole = np.asarray(whole.cast(pa.uint8())).astype(bool)
    words = split_spaces(pc.if_else(pa.array(whole), "", texts))
    return texts, whole, words, words.bounds[:-1]


def lexicon_words(docs: DataFrame, most: int = LEXICON_WORDS) -> DataFrame:
    """The most frequent pieces of at most PIECE_BYTES over all texts, at most ``most``, those of equal frequency all or
    none: piece, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            _, _, words, first = _pieces(batch)
            n = np.bincount(words.codes, minlength=len(words.distinct)) - np.bincount(
                words.codes[first], minlength=len(words.distinct)
            )
            often = (n > 0) & (np.asarray(pc.binary_length(words.distinct)) <= PIECE_BYTES)
            yield pa.RecordBatch.from_arrays(
                [words.distinct.filter(pa.array(often)), pa.array(n[often], pa.int64())], names=["piece", "n"]
            )

    ship(docs.sparkSession)
    counted = docs.select("text").mapInArrow(count, "piece string, n bigint")
    counted = stage(counted.groupBy("piece").agg(F.sum("n").alias("n")).where("n > 1"), "pieces")
    # Steps of an eighth of a doubling: a few hundred rows tell the least count that at most ``most`` pieces reach.
    step = F.floor(F.log2("n") * 8).alias("step")
    room, least = most, None
    for row in counted.groupBy(step).agg(F.count(F.lit(1)).alias("pieces")).orderBy(F.desc("step")).collect():
        room -= row.pieces
        if room < 0:
            break
        least = row.step
    return counted.where(step >= least) if least is not None else counted.limit(0)


def publish_lexicon(docs: DataFrame, path: str, most: int = LEXICON_WORDS) -> str:
    """Compile the lexicon (at most ``most`` words reach the driver) and add it to the application's files.

    Equal lexicons of an application are one file; its folder goes when the driver's process ends.
    """
    words = sorted(" ".encode() + r.piece.encode() for r in lexicon_words(docs, most).collect())
    data = compile_words(words, id_lists(path)([w.decode() for w in words]) if words else [])
    context = docs.sparkSession.sparkContext
    name = f"lexicon-{hashlib.sha256(data.tobytes()).hexdigest()[:32]}.npy"
    if (context.applicationId, name) not in _published:
        target = Path(_lexicon_folder().name) / f"{context.applicationId}-{name}"
        np.save(target, data)
        context.addFile(str(target))
        _published[context.applicationId, name] = target.name
    return _published[context.applicationId, name]


_published: dict[tuple[str, str], str] = {}


@lru_cache(maxsize=1)
def _lexicon_folder() -> tempfile.TemporaryDirectory:
    """The driver's own folder, from which Spark serves files to executors; removed at the end."""
    return tempfile.TemporaryDirectory(prefix="ampline-lexicon-", ignore_cleanup_errors=True)


@lru_cache(maxsize=2)
def _lexicon(name: str) -> Transducer:
    return Transducer(np.load(SparkFiles.get(name), mmap_mode="r"))


@lru_cache(maxsize=2)
def _memo(path: str) -> Memo:
    encode = id_lists(path)
    return Memo(lambda pieces: flattened(encode(pieces)))


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of every token and its decimal id with a comma, each as starts and one flat array."""
    # The byte alphabet of byte-level vocabularies, a fixed rule: printable bytes stand for themselves, others follow from 256.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    tokenizer = open_tokenizer(path)
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    raw = [bytes(byte[c] for c in tokenizer.id_to_token(i) or "") for i in range(size)]
    digits = [b"%d," % i for i in range(size)]

    def flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(([0], np.cumsum([len(p) for p in parts]))), np.frombuffer(b"".join(parts), np.uint8)

    return (*flat(raw), *flat(digits))


def _spelled(ids: np.ndarray, lengths: np.ndarray, bounds: np.ndarray, flat: np.ndarray) -> list[bytes]:
    """For each piece of ``lengths`` ids, the flat bytes of its ids one after the other."""
    size = bounds[ids + 1] - bounds[ids]
    data = flat[ragged(bounds[ids], size)].tobytes()
    ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(lengths)))].tolist()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def _piece_ids(lexicon: Transducer, memo: Memo, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces in order, and their number by piece."""
    ranks = lexicon.ranks(pieces)
    unseen = ranks < 0
    merged = memo(pieces.filter(pa.array(unseen)).to_pylist())
    lengths = np.empty(len(pieces), np.int64)
    lengths[~unseen] = lexicon.bounds[ranks[~unseen] + 1] - lexicon.bounds[ranks[~unseen]]
    lengths[unseen] = np.fromiter(map(len, merged), np.int64, len(merged)) // 4
    ids = np.empty(int(lengths.sum()), np.int64)
    starts = np.cumsum(lengths) - lengths
    ids[ragged(starts[~unseen], lengths[~unseen])] = lexicon.ids[ragged(lexicon.bounds[ranks[~unseen]], lengths[~unseen])]
    ids[ragged(starts[unseen], lengths[unseen])] = np.frombuffer(b"".join(merged), "<u4")
    return ids, lengths


def _encoded(batch: pa.RecordBatch, lexicon: Transducer, path: str) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    """By text: number of ids, the ids in decimal joined by commas, the decoded bytes."""
    texts, whole, words, first = _pieces(batch)
    memo, encode = _memo(path), id_lists(path)
    raw_bounds, raw, digit_bounds, digits = _token_bytes(path)
    distinct = words.distinct
    led = pc.binary_join_element_wise(pa.scalar(" "), distinct, "")  # all pieces but a text's first follow a space
    ids, lengths = _piece_ids(lexicon, memo, led)
    spelled = np.array(_spelled(ids, lengths, digit_bounds, digits) + [b""], object)
    decoded = np.array(_spelled(ids, lengths, raw_bounds, raw) + [b""], object)

    heads = np.array(memo(distinct.take(pa.array(words.codes[first])).to_pylist()), object)
    for i in np.flatnonzero(whole):
        heads[i] = np.array(encode([texts[int(i)].as_py()])[0], "<u4").tobytes()
    head_lengths = np.fromiter(map(len, heads), np.int64, len(heads)) // 4
    head_ids = np.frombuffer(b"".join(heads), "<u4").astype(np.int64)
    head_spelled = _spelled(head_ids, head_lengths, digit_bounds, digits)
    head_decoded = _spelled(head_ids, head_lengths, raw_bounds, raw)

    n_ids, id_texts, decoded_texts = [], [], []
    bounds = words.bounds.tolist()
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        codes = words.codes[low + 1 : high]
        n_ids.append(int(head_lengths[i]) + int(lengths[codes].sum()))
        id_texts.append((head_spelled[i] + b"".join(spelled[codes]))[:-1])
        decoded_texts.append(head_decoded[i] + b"".join(decoded[codes]))
    return np.array(n_ids, np.int64), id_texts, decoded_texts


def encode_decode(docs: DataFrame, path: str, keys: list[str], most: int = LEXICON_WORDS) -> DataFrame:
    """The columns ``keys`` of ``docs``, n_tokens, ids (decimal, joined by commas) and decoded text."""
    return _mapped(docs, path, keys, most, "ids string, decoded string", _whole_columns)


def digests(docs: DataFrame, path: str, keys: list[str], most: int = LEXICON_WORDS) -> DataFrame:
    """Like ``encode_decode``, with SHA-256 digests in place of ids and text."""
    return _mapped(docs, path, keys, most, "ids_sha256 string, decoded_sha256 string", _digest_columns)


def _whole_columns(ids: list[bytes], decoded: list[bytes]) -> list[pa.Array]:
    return [pa.array([x.decode() for x in ids], pa.string()), pa.array([x.decode("utf-8", "replace") for x in decoded], pa.string())]


def _digest_columns(ids: list[bytes], decoded: list[bytes]) -> list[pa.Array]:
    valid = (x.decode("utf-8", "replace").encode() for x in decoded)
    return [pa.array([hashlib.sha256(x).hexdigest() for x in part], pa.string()) for part in (ids, valid)]


def _mapped(docs: DataFrame, path: str, keys: list[str], most: int, outputs: str, columns) -> DataFrame:
    ship(docs.sparkSession)
    name = publish_lexicon(docs, path, most)
    source = docs.select(*keys, F.col("text").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(name)
        for batch in text_slices(batches):
            n, ids, decoded = _encoded(batch, lexicon, path)
            kept = [batch.column(i) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n, pa.int64()), *columns(ids, decoded)],
                names=[*batch.schema.names[: len(keys)], "n_tokens", *[x.split()[0] for x in outputs.split(", ")]],
            )

    return source.mapInArrow(encode, with_fields(docs.select(*keys), f"n_tokens bigint, {outputs}"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), public_path(TOKENIZER), ["doc_id"])

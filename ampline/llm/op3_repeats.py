"""Removal of long repeats: every byte covered by a string of WINDOW bytes that also starts anywhere else.

One index over all text would have to fit one task, and indexes over shards would have to be streamed past each other, so
the candidates are brought together first. Every text is cut into runs of windows that share a winnowed k-gram (see
``windows``); equal windows have equal k-grams. The k-grams' hashes only bring runs together and decide nothing. Runs whose
k-gram occurs once are done. Runs with equal contexts (the bytes of all their windows, by cryptographic digests of 128 bits)
are repeats as a whole, and one of them stands for all. The remaining contexts, one of each kind, are dealt to tasks by
k-gram and laid into run-length indexes of SHARD_BYTES, whose matching statistics tell the windows that occur twice. Contexts
of a k-gram with more than CROWD of them are too many for one index, so they are split further, into single windows, which
are contexts of their own and settled like those above, by digests.

Counts by key have map-side parts. Rows of a hot key are dealt into parts before they are joined with it. No text is sent
more than to find contexts and to remove bytes.

Matches never cross documents; strings are judged on the input. Null and empty texts have no bytes; texts below WINDOW
bytes and texts that occur once as a whole may still lose nothing. Repeated rows are repeats of each other. Rows are told
apart by file and place, so ids may be null or occur often.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampline.llm.common import documents, ship, string_column, text_slices, with_fields
from ampline.llm.run_index import matching_statistics
from ampline.llm.windows import WINDOW, Hashes, digests, find_runs
from ampline.staging import counted, stage

CROWD = 4000             # contexts of a k-gram that one index takes, at most
SHARD_BYTES = 1 << 20
BLOCK_BYTES = 2 << 20    # text hashed at a time; longer texts are cut
SEPARATOR = b"\xff"      # in no UTF-8 text
GRAM_BITS = 64           # of a k-gram's hash
PART_ROWS = 1000         # rows of a hot key that one part takes, at least
RUNS = "file bigint, at bigint, first int, last int, gram bigint, context bigint, context2 bigint"
CONTEXT = ["context", "context2"]


def placed(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` in ``row``, and file (hash of its path) and at, which tell rows apart."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
    try:
        return docs.select(row, *place)
    except AnalysisException:  # not over files
        return stage(docs, "content").select(row, *place)


# ---- runs ---------------------------------------------------------------------------------------------------------


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row and offset of some pieces of texts, their bytes and bounds; the batch's last column is the text.

    A long text is cut into pieces that overlap by a window less a byte, so that each window lies in one piece. A run
    that is cut there becomes two, which costs a comparison more and changes no result.
    """
    pieces: list[tuple[int, int, bytes]] = []
    size = 0
    for row, text in enumerate(string_column(batch.column(batch.num_columns - 1)).cast(pa.binary())):
        text = text.as_py()
        for start in range(0, max(1, len(text) - WINDOW + 1), BLOCK_BYTES):
            piece = text[start : start + BLOCK_BYTES + WINDOW - 1]
            if pieces and size + len(piece) > BLOCK_BYTES:
                yield _joined(pieces)
                pieces, size = [], 0
            pieces.append((row, start, piece))
            size += len(piece)
    if pieces:
        yield _joined(pieces)


def _joined(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rows, starts, parts = zip(*pieces)
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    return np.array(rows), np.array(starts), np.frombuffer(b"".join(parts), np.uint8), bounds


def runs_of(rows: DataFrame) -> DataFrame:
    """The runs of all texts: row, first and last window, hash of the k-gram and digest of the context."""
    mask = np.uint64((1 << GRAM_BITS) - 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            file, at = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for row, start, data, bounds in _blocks(batch):
                runs = find_runs(data, bounds, Hashes(data))
                context, context2 = digests(data, runs.first, runs.last + WINDOW)
                owner = np.searchsorted(bounds, runs.first, "right") - 1
                shift = start[owner] - bounds[owner]
                columns = [
                    pa.array(file[row[owner]]), pa.array(at[row[owner]]),
                    pa.array((runs.first + shift).astype(np.int32)), pa.array((runs.last + shift).astype(np.int32)),
                    pa.array((runs.gram & mask).view(np.int64)), pa.array(context), pa.array(context2),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "at", "first", "last", "gram", *CONTEXT])

    ship(rows.sparkSession)
    return rows.select("file", "at", F.col("row.text").alias("text")).mapInArrow(cut, RUNS)


# ---- repeats among contexts ---------------------------------------------------------------------------------------


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by gram, regrouped into shards of about SHARD_BYTES that hold grams whole."""
    kept: list[pa.RecordBatch] = []

    def take(table: pa.Table, final: bool) -> Iterator[pa.Table]:
        grams = np.asarray(table.column("gram"))
        size = np.cumsum(np.asarray(pc.binary_length(table.column("bytes"))).astype(np.int64))
        ends = np.concatenate((np.flatnonzero(grams[1:] != grams[:-1]) + 1, [len(grams)] if final else [])).astype(np.int64)
        low = 0
        for i, end in enumerate(ends):
            full = size[end - 1] - (size[low - 1] if low else 0) >= SHARD_BYTES
            if full or (final and i == len(ends) - 1):
                yield table.slice(low, int(end) - low)
                low = int(end)
        if low < len(grams):
            kept[:] = table.slice(low).to_batches()
        else:
            kept[:] = []

    held = 0
    for batch in batches:
        kept.append(batch)
        held += batch.nbytes
        if held >= SHARD_BYTES:
            yield from take(pa.Table.from_batches(kept), final=False)
            held = sum(b.nbytes for b in kept)
    if kept:
        yield from take(pa.Table.from_batches(kept), final=True)


def _ranges(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each stretch of true values."""
    edges = np.flatnonzero(np.diff(marks.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2] - 1


def indexed_repeats(contexts: DataFrame) -> DataFrame:
    """file, at, low, high: stretches of windows of ``contexts`` (file, at, first, gram, bytes) that occur twice."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            parts = shard.column("bytes").to_pylist()
            data = np.frombuffer(SEPARATOR.join(parts) + SEPARATOR, np.uint8)
            starts = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])))[:-1]
            left = np.concatenate([np.arange(len(p), -1, -1) for p in parts])  # bytes up to the separator
            low, high = _ranges((matching_statistics(data) >= WINDOW) & (left >= WINDOW))
            owner = np.searchsorted(starts, low, "right") - 1
            shift = np.asarray(shard.column("first")).astype(np.int64)[owner] - starts[owner]
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    shard.column("file").combine_chunks().take(rows), shard.column("at").combine_chunks().take(rows),
                    pa.array((low + shift).astype(np.int32)), pa.array((high + shift).astype(np.int32)),
                ],
                names=["file", "at", "low", "high"],
            )

    dealt = contexts.repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(mark, "file bigint, at bigint, low int, high int")


def counted_repeats(contexts: DataFrame) -> DataFrame:
    """Like ``indexed_repeats``, window by window, each a context of its own."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "bytes"):
            parts = batch.column(batch.schema.get_field_index("bytes")).to_pylist()
            bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            data = np.frombuffer(b"".join(parts), np.uint8)
            counts = np.diff(bounds) - WINDOW + 1
            owner = np.repeat(np.arange(len(parts)), counts)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            context, context2 = digests(data, bounds[owner] + inside, bounds[owner] + inside + WINDOW)
            rows = pa.array(owner)
            low = np.asarray(batch.column(2)).astype(np.int64)[owner] + inside
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(low.astype(np.int32)), pa.array(context), pa.array(context2)],
                names=["file", "at", "low", *CONTEXT],
            )

    windows = contexts.select("file", "at", "first", "bytes").mapInArrow(spread, "file bigint, at bigint, low int, context bigint, context2 bigint")
    windows = stage(windows, "windows")
    often = windows.groupBy(CONTEXT).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    often, figures = counted(often, "windows-often", {"total": "sum(n)"})
    found = joined(windows, often, CONTEXT, ["file", "at", "low"], figures["total"])
    return found.select("file", "at", "low", F.col("low").alias("high"))


def joined(rows: DataFrame, keys: DataFrame, on: list[str], place: list[str], total: int | None) -> DataFrame:
    """``rows`` with the columns of their key, of those that have one.

    ``keys`` has each key once, with ``n``, the number of its rows, and ``total`` is the sum of all ``n``. The rows of a key
    with over a thousandth of them are dealt by ``place`` into parts that have no more. There are at most 1,000 such keys,
    so they are broadcast, and at most 2,000 parts of them.
    """
    most = max(PART_ROWS, (total or 0) // 1000)
    parts = F.ceil(F.col("n") / most).cast("int")
    hot = keys.where(F.col("n") > most).select(*[F.col(c).alias(f"hot_{c}") for c in on], parts.alias("parts"))
    part = F.coalesce(F.pmod(F.xxhash64(*place), F.col("parts")).cast("int"), F.lit(0)).alias("part")
    dealt = rows.join(F.broadcast(hot), [F.col(c) == F.col(f"hot_{c}") for c in on], "left").select(*rows.columns, part)
    spread = keys.withColumn("key_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    spread = spread.select(*[F.col(c).alias(f"key_{c}") if c in on else c for c in spread.columns if c != "n"])
    found = dealt.join(spread, [F.col(c) == F.col(f"key_{c}") for c in [*on, "part"]])
    return found.drop("part", "key_part", *[f"key_{c}" for c in on])


def repeats(rows: DataFrame) -> DataFrame:
    """file, at, low, high: stretches of windows (first and last start) that occur elsewhere too."""
    runs = runs_of(rows)
    same = (F.min("context") == F.max("context")) & (F.min("context2") == F.max("context2"))
    several = runs.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), same.alias("alike")).where("n > 1")
    several, figures = counted(several, "grams", {"total": "sum(n)"})
    common = stage(joined(runs, several, ["gram"], ["file", "at", "first"], figures["total"]), "runs")
    alike = common.where("alike")
    mixed = common.where("NOT alike").drop("alike")

    place = F.struct("file", "at", "first", "last").alias("place")
    kinds = mixed.groupBy("gram", *CONTEXT).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("place"))
    kinds, figures = counted(kinds, "contexts", {"total": "sum(n)", "kinds": "count(1)"})
    twice = kinds.where("n > 1").drop("place")
    copied = joined(mixed, twice, ["gram", *CONTEXT], ["file", "at", "first"], figures["total"])
    whole = alike.select("file", "at", "first", "last").unionByName(copied.select("file", "at", "first", "last"))

    # Grams all of whose contexts occur twice are done; of the others one context of each kind is looked into.
    grams = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("n").alias("least")).where("least = 1")
    grams = stage(grams.select("gram", "n", (F.col("n") > CROWD).alias("crowded")), "open-grams")
    open_kinds = joined(kinds.select("gram", "place"), grams, ["gram"], ["place"], figures["kinds"]).select("place.*", "gram", "crowded")
    wanted = open_kinds.groupBy(F.col("file").alias("f"), F.col("at").alias("a")).agg(
        F.collect_list(F.struct("first", "last", "gram", "crowded")).alias("wanted")
    )
    texts = rows.select("file", "at", F.col("row.text").cast("binary").alias("bytes"))
    asked = texts.join(wanted, (F.col("file") == F.col("f")) & (F.col("at") == F.col("a")))
    contexts = asked.select("file", "at", "bytes", F.explode("wanted").alias("w")).select(
        "file", "at", F.col("w.first").alias("first"), F.col("w.gram").alias("gram"), F.col("w.crowded").alias("crowded"),
        F.expr(f"substring(bytes, w.first + 1, w.last - w.first + {WINDOW})").alias("bytes"),
    )
    contexts = stage(contexts, "open-contexts")
    parts = indexed_repeats(contexts.where("NOT crowded")).unionByName(counted_repeats(contexts.where("crowded")))
    return whole.select("file", "at", F.col("first").alias("low"), F.col("last").alias("high")).unionByName(parts)


# ---- removal ------------------------------------------------------------------------------------------------------


def _covered(size: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of ``size`` bytes lie in a window that starts in one of the stretches."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, low, 1)
    np.add.at(edges, high + WINDOW, -1)
    return np.cumsum(edges[:-1]) > 0


def with_marks(rows: DataFrame) -> DataFrame:
    """``row`` and marks, the list of stretches of its repeated windows; null if there are none."""
    marks = repeats(rows).groupBy(F.col("file").alias("f"), F.col("at").alias("a")).agg(
        F.collect_list(F.struct("low", "high")).alias("marks")
    )
    return rows.join(marks, (F.col("file") == F.col("f")) & (F.col("at") == F.col("a")), "left").select("row", "marks")


RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def removal(docs: DataFrame, digest: bool = False) -> DataFrame:
    """All columns of ``docs`` in ``row``, bytes before, bytes and spans removed, and the bytes kept (or their SHA-256)."""
    rows = with_marks(placed(docs)).select("row", "marks", F.col("row.text").alias("text"))
    if digest:
        rows = rows.withColumn("row", F.struct("row.doc_id"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            out = []
            texts = string_column(batch.column(2)).cast(pa.binary())
            for text, marks in zip(texts.to_pylist(), batch.column(1).to_pylist()):
                kept, spans = text, 0
                if marks:
                    gone = _covered(len(text), np.array([m["low"] for m in marks]), np.array([m["high"] for m in marks]))
                    kept, spans = np.frombuffer(text, np.uint8)[~gone].tobytes(), len(_ranges(gone)[0])
                out.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest().encode() if digest else kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", "n_bytes", "n_removed", "n_spans", "kept"])

    ship(docs.sparkSession)
    return rows.mapInArrow(remove, with_fields(rows.select("row"), RESULT))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = removal(documents(spark, sf_dir).select("doc_id", "text"), digest=True)
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").cast("string").alias("kept_sha256"))

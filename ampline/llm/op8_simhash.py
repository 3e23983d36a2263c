"""Near-duplicates by SimHash fingerprints of word shingles.

A text's fingerprint has a bit set where over half of its shingles' XXH64 hashes have it. Rows with equal fingerprints
collapse first; links are searched between distinct fingerprints.

Search: a fingerprint is embedded as the bit counts of its SEGMENTS segments. The Manhattan distance of two embeddings is
at most the Hamming distance, so fingerprints within ``distance`` bits lie within that Manhattan distance too. The grid
groups the axes into ``distance + EQUAL_GROUPS`` groups: of two points within the distance, at least EQUAL_GROUPS groups
of axes have equal counts. Every choice of EQUAL_GROUPS groups is a projection of the grid with cells of width one, and
points that share a cell are compared: Manhattan distance first, then the exact bit distance.

Cells of up to CELL_POINTS points are compared in blocks inside a task, which returns the links that join parts not yet
joined in the cell, never all pairs. Points of larger cells take an exact way without comparisons: two fingerprints
are within 4 bits just if some value is within 2 bits of each, so all points around a value are joined with the smallest.

Links become components by alternating star contraction over written tables. Each row gets the smallest document id of
its component. Null and wordless texts have fingerprint zero and are linked like any other; null ids are not counted as
smallest, and a component without any id has a null id. Repeated rows have equal fingerprints, so they share a component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampline.llm.common import documents, ship, string_column, text_slices, with_fields
from ampline.staging import stage

SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42
SEGMENTS = 32
EQUAL_GROUPS = 4
CELL_POINTS = 20_000
SMALL_CELL = 64  # cells up to this size are compared many at a time
BLOCK = 1024  # points of a larger cell compared with each other at a time


# ---- fingerprints -------------------------------------------------------------------------------------------------


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - words_per_shingle + 1)
    shingles = map(b" ".join, zip(*(words[i : i + n] for i in range(words_per_shingle)))) if n > 1 else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for low in range(0, n, 1 << 16):
        part = hashes[low : low + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """All columns of ``docs`` in ``row``, and fp, the fingerprint as a signed 64-bit integer."""
    fps = _fingerprinted(docs, docs.columns, words_per_shingle)
    return fps.select(F.struct(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]).alias("row"), "fp")


def _fingerprinted(docs: DataFrame, kept: list[str], words_per_shingle: int) -> DataFrame:
    """The columns ``kept`` as c0, c1 and so on, and fp. The text goes to Python once."""
    names = [f"c{i}" for i in range(len(kept))]
    source = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names)], *([] if "text" in kept else ["text"]))
    place = names[kept.index("text")] if "text" in kept else "text"

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, place):
            texts = string_column(batch.column(batch.schema.get_field_index(place))).cast(pa.binary())
            fps = np.array([fingerprint(t.as_py(), words_per_shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(fps)], names=[*names, "fp"])

    ship(docs.sparkSession)
    return source.mapInArrow(compute, with_fields(source.select(*names), "fp bigint"))


# ---- links between distinct fingerprints --------------------------------------------------------------------------


def axis_groups(distance: int) -> list[tuple[int, int]]:
    """Ranges of segments; the number of groups is such that EQUAL_GROUPS of them stay equal within the distance."""
    cuts = np.linspace(0, SEGMENTS, distance + EQUAL_GROUPS + 1).round().astype(int)
    return list(zip(cuts.tolist(), cuts[1:].tolist()))


def embed(fps: np.ndarray) -> np.ndarray:
    """Bit counts of the segments of each fingerprint."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(fps), SEGMENTS, -1).sum(axis=2, dtype=np.uint8)


def _dealt(points: DataFrame) -> DataFrame:
    """Fingerprints over as many tasks as a shuffle has, as each becomes many rows."""
    return points.select("fp").repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")


def grid_cells(points: DataFrame, distance: int) -> DataFrame:
    """Each fp with the cells of all projections: the projection's number and the counts on its axes, packed."""
    groups = axis_groups(distance)
    width = (64 // SEGMENTS).bit_length()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column(0))
            counts = embed(fps.view(np.uint64)).astype(np.int64)
            packed = []
            for low, high in groups:
                key = np.zeros(len(fps), np.int64)
                for axis in range(low, high):
                    key = key << width | counts[:, axis]
                packed.append(key)
            for number, chosen in enumerate(combinations(range(len(groups)), EQUAL_GROUPS)):
                cell = np.full(len(fps), number, np.int64)
                for g in chosen:
                    cell = cell << width * (groups[g][1] - groups[g][0]) | packed[g]
                yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column(0)], names=["cell", "fp"])

    return _dealt(points).mapInArrow(place, "cell bigint, fp bigint")


def _within(left: np.ndarray, right: np.ndarray, distance: int) -> np.ndarray:
    """Which of the pairs lie within the distance: first by segment counts, then on all bits."""
    apart = np.abs(embed(left).view(np.int8) - embed(right).view(np.int8)).sum(axis=1)
    near = np.flatnonzero(apart <= distance)
    exact = np.zeros(len(left), bool)
    exact[near] = np.bitwise_count(left[near] ^ right[near]) <= distance
    return exact


def _close_pairs(fps: np.ndarray, starts: np.ndarray, sizes: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs within the distance inside each cell, some cells or blocks at a time."""
    for size in np.unique(sizes[sizes <= SMALL_CELL]):
        i, j = np.triu_indices(int(size), 1)
        cells = starts[sizes == size]
        step = max(1, (1 << 18) // len(i))
        for low in range(0, len(cells), step):
            at = cells[low : low + step, None]
            x, y = (at + i).ravel(), (at + j).ravel()
            near = _within(fps[x], fps[y], distance)
            yield x[near], y[near]
    for start, size in zip(starts[sizes > SMALL_CELL].tolist(), sizes[sizes > SMALL_CELL].tolist()):
        counts = embed(fps[start : start + size])
        for low in range(0, size, BLOCK):
            for other in range(low, size, BLOCK):
                a, b = counts[low : low + BLOCK], counts[other : other + BLOCK]
                apart = np.zeros((len(a), len(b)), np.uint8)
                for axis in range(SEGMENTS):
                    one, two = a[:, axis, None], b[None, :, axis]
                    apart += np.maximum(one, two) - np.minimum(one, two)
                x, y = np.nonzero(apart <= distance)
                x, y = x + start + low, y + start + other
                near = (x < y) & (np.bitwise_count(fps[x] ^ fps[y]) <= distance)
                yield x[near], y[near]


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of the pairs of positions below ``n``, a forest that joins what they join."""
    label = np.arange(n)
    for i, j in pairs:
        while len(i):
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            high, first = np.unique(np.maximum(label[i], label[j]), return_index=True)
            if not len(high):
                break
            yield i[first], j[first]
            target = np.arange(n)
            target[high] = np.minimum(label[i], label[j])[first]
            while (target[target] != target).any():
                target = target[target]
            label = target[label]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of rows sorted by cell, regrouped so that no cell is cut."""
    cells, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        cells = np.concatenate((cells, np.asarray(batch.column(0))))
        fps = np.concatenate((fps, np.asarray(batch.column(1))))
        last = int(np.searchsorted(cells, cells[-1])) if len(cells) else 0
        if last:
            yield cells[:last], fps[:last]
            cells, fps = cells[last:], fps[last:]
    if len(cells):
        yield cells, fps


def cell_links(cells: DataFrame, distance: int) -> DataFrame:
    """Links a, b inside cells (cell, fp) of at most CELL_POINTS points."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, fps in _runs(batches):
            fps = fps.view(np.uint64)
            edges = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1, append=keys[-1] + 1))
            sizes = np.diff(edges)
            for i, j in _forest(len(fps), _close_pairs(fps, edges[:-1], sizes, distance)):
                yield pa.RecordBatch.from_arrays([pa.array(fps[i].view(np.int64)), pa.array(fps[j].view(np.int64))], names=["a", "b"])

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, "a bigint, b bigint")


def midpoint_links(points: DataFrame, distance: int) -> DataFrame:
    """Links of points that share a value within ``distance / 2`` bits; linear in the points, whatever their density."""
    flips = np.array(
        [sum(1 << b for b in chosen) for n in range(distance // 2 + 1) for chosen in combinations(range(64), n)], np.uint64
    )

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column(0)).view(np.uint64)
            for low in range(0, len(fps), 256):
                part = fps[low : low + 256]
                values = (part[:, None] ^ flips[None, :]).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(np.repeat(part, len(flips)).view(np.int64))], names=["value", "fp"]
                )

    spread = _dealt(points).mapInArrow(around, "value bigint, fp bigint")
    least = spread.groupBy("value").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").select("value", "a")
    return spread.join(least, "value").where("fp != a").select("a", F.col("fp").alias("b")).distinct()


def links(points: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links that connect what any pairs of ``points`` (distinct fp) within the distance connect."""
    if distance % 2:
        raise ValueError("an even distance is needed, as points of large cells meet half way")
    ship(points.sparkSession)
    cells = grid_cells(points, distance)
    sizes = cells.groupBy(F.col("cell").alias("of")).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stage(cells.join(sizes, F.col("cell") == F.col("of")).select("cell", "fp", "size"), "cells")
    dense = shared.where(F.col("size") > CELL_POINTS).select("fp").distinct()
    small = shared.where(F.col("size") <= CELL_POINTS).select("cell", "fp")
    return cell_links(small, distance).unionByName(midpoint_links(dense, distance))


# ---- components ---------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b), root being the smallest node of its component.

    Large-star and small-star steps in turn (Kiveris et al., 2014) until the edges are stars. Steps aggregate by node
    with map-side parts, and each round is written, so that plans stay short.
    """
    edges = stage(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        small = stage(small.distinct(), "small-star")
        inner = small.join(small.select(F.col("u").alias("r")).distinct(), F.col("v") == F.col("r"), "left_semi").select("u")
        several = small.groupBy("u").count().where("count > 1").select("u")
        edges = small
        if inner.unionAll(several).isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def classes(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """fp, root and component_id for every distinct fp of ``rows`` (doc_id, fp)."""
    points = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    roots = stage(components(links(points, distance)), "roots")
    rooted = points.join(roots, points["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = stage(_fingerprinted(docs, ["doc_id"], SHINGLE_WORDS).select(F.col("c0").alias("doc_id"), "fp"), "fingerprints")
    found = classes(rows).select(F.col("fp").alias("of"), "component_id")
    joined = rows.join(found, rows["fp"] == found["of"])
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """One row of each component, with all columns: the one with the smallest document id, of equal ids the first."""
    rows = fingerprints(docs, words_per_shingle).withColumn("at", F.monotonically_increasing_id())
    rows = stage(rows, "fingerprinted")  # fixes ``at``
    keyed = rows.select("at", "fp", F.col("row.doc_id").alias("doc_id"))
    found = classes(keyed.select("doc_id", "fp"), distance).select(F.col("fp").alias("of"), "root")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at"))
    kept = keyed.join(found, keyed["fp"] == found["of"]).groupBy("root").agg(least.alias("least")).select(F.col("least.at").alias("kept"))
    return rows.join(kept, rows["at"] == kept["kept"], "left_semi").select("row.*")

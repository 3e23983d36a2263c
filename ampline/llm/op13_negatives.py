"""Hard-negative mining by slots between the positives' upper limits.

Every anchor is scored against every row in blocks: rows are packed into chunks of one label, anchors into blocks, and
each block meets each chunk once in a join on a part number that blocks are copied to, so neither side is broadcast or
collected. Inside a task a block and a chunk are one matrix product.

1. Positives: blocks of one label meet the chunks of that label; each task keeps an anchor's best few rows.
2. An anchor's positives, best first, have falling upper limits. These cut the scores into disjoint slots, slot j from
   the limit of positive j down to that of positive j + 1, the last one down to the least lower limit of all.
3. Blocks of any labels meet all chunks; each task keeps the best k rows of every slot (the combiner), and one rank
   filter by anchor and slot merges the tasks.
4. What lies below the limit of positive j is slot j and all behind it. Going from the last slot up, the best k of a
   slot put before the best k behind it are the best k below that limit; the lower limit then cuts the list's end. So
   the overlapping windows of all positives are answered from at most k rows per slot.

Scores are exact: products are taken in 32-bit or 64-bit floating point where the vectors' lengths prove all partial
sums to be exact whole numbers, else in 64-bit integers (which wrap beyond their range).

Defined results: rows with a null label, a null vector or a null or non-finite component take no part. A shorter vector
counts as filled up with zeros. Among equal scores null ids come last. Rows are told apart by their place in the written
table, so repeated rows are anchors, positives and negatives one by one. An anchor without positives, or a positive
without negatives, gives no rows. Only vec_id, embedding and label are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampline.llm.common import batches_of, ship
from ampline.staging import stage

CHUNK_ROWS = 8192     # of all labels together; a chunk holds those of one label
BLOCK_ANCHORS = 4096  # on average, as for chunks
PART_CHUNKS = 64      # chunk numbers that one task handles, at most and on average
PAIRS_PER_BATCH = 8   # pairs of a block and a chunk sent to Python at a time
NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Mining:
    positives: int = 5
    negatives: int = 3
    low_percent: int = 50    # of the positive's score, at least
    high_percent: int = 95   # at most


# ---- one block against one chunk -----------------------------------------------------------------------------------


def _matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    """Vectors as rows of 64-bit integers, filled up with zeros."""
    offsets = np.asarray(lists.offsets, np.int64)
    values, lengths = np.asarray(lists.values, np.int64), np.diff(offsets)
    out = np.zeros((len(lists), dims), np.int64)
    inside = np.arange(dims) < lengths[:, None]
    out[inside] = values[offsets[0] : offsets[-1]]
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` with all of ``b``, exact; floating point where lengths prove it to be."""
    longest = [float(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0))) for x in (a, b)]
    bound = 1.001 * longest[0] * longest[1]  # no partial sum exceeds it
    for kind, most in ((np.float32, 2.0**24), (np.float64, 2.0**53)):
        if bound < most and max(longest) < most:
            return a.astype(kind) @ b.astype(kind).T
    return a @ b.T


class Best:
    """The best ``k`` rows of every list; a list is an anchor, or an anchor's slot."""

    def __init__(self, n_lists: int, k: int):
        self.k = k
        self.list = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.row = np.zeros(0, np.int64)
        self.limit = np.full(n_lists, np.iinfo(np.int64).min)  # the last score of a full list

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        useful = scores >= self.limit[lists]
        if not useful.any():
            return
        columns = [
            np.concatenate((old, new[useful]))
            for old, new in ((self.list, lists), (self.score, scores), (self.id, ids), (self.row, rows))
        ]
        # ~score falls as the score grows, without overflow.
        order = np.lexsort((columns[3], columns[2], ~columns[1], columns[0]))
        held = columns[0][order]
        nth = np.arange(len(held)) - np.searchsorted(held, held)
        self.list, self.score, self.id, self.row = (c[order][nth < self.k] for c in columns)
        full = held[nth == self.k - 1]
        self.limit[full] = columns[1][order][nth == self.k - 1]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict, dict]]:
    """The pairs of a block and a chunk: whether a new block begins, and the columns of both."""
    last, block = None, {}
    for batch in batches:
        columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            key = columns["block"][i].as_py()
            read = lambda name: columns[name][i].values  # noqa: B023
            if key != last:
                anchors = read("anchors")
                block = {f.name: anchors.field(j) for j, f in enumerate(anchors.type)}
            rows = read("rows")
            yield key != last, block, {f.name: rows.field(j) for j, f in enumerate(rows.type)} | {"label": columns["label"][i].as_py()}
            last = key


def _scored(anchors: dict, rows: dict) -> np.ndarray:
    longest = max(int(np.diff(np.asarray(x["vector"].offsets)).max(initial=0)) for x in (anchors, rows))
    return products(_matrix(anchors["vector"], longest), _matrix(rows["vector"], longest))


def _numbers(column: pa.Array) -> np.ndarray:
    return np.asarray(column, np.int64)


def _best_rows(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """By anchor, the best ``k`` other rows among the chunks of a task."""
    best, anchors = None, {}

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (_numbers(anchors["nth"])[best.list], best.score, best.id, best.row)],
            names=["anchor", "score", "id", "row"],
        )

    for begins, block, rows in _blocks(batches):
        if begins:
            if best:
                yield flush()
            anchors, best = block, Best(len(block["nth"]), k)
        scores = _scored(block, rows)
        own = _numbers(block["nth"])[:, None] != _numbers(rows["nth"])
        lists, at = np.nonzero(own & (scores >= best.limit[:, None]))
        best.add(lists, scores[lists, at].astype(np.int64), _numbers(rows["id"])[at], _numbers(rows["nth"])[at])
    if best:
        yield flush()


def slots_of(scores: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The slot of each score: the last of its row of falling limits that is not below it; -1 above all."""
    return (limits >= scores[:, None]).sum(axis=1) - 1


def _best_by_slot(batches: Iterator[pa.RecordBatch], k: int, n_slots: int) -> Iterator[pa.RecordBatch]:
    """By anchor and slot, the best ``k`` rows of other labels among the chunks of a task."""
    best, anchors = None, {}

    def flush() -> pa.RecordBatch:
        anchor, slot = np.divmod(best.list, n_slots)
        columns = (_numbers(anchors["nth"])[anchor], slot, best.score, best.id, best.row)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["anchor", "slot", "score", "id", "row"])

    for begins, block, rows in _blocks(batches):
        if begins:
            if best:
                yield flush()
            anchors, best = block, Best(len(block["nth"]) * n_slots, k)
            labels, low = _numbers(block["label"]), _numbers(block["low"])
            limits = np.full((len(low), n_slots), np.iinfo(np.int64).min)  # anchors with fewer positives have fewer slots
            lists = block["high"]
            offsets = np.asarray(lists.offsets, np.int64)
            limits[np.arange(n_slots) < np.diff(offsets)[:, None]] = np.asarray(lists.values, np.int64)[offsets[0] : offsets[-1]]
            last = np.arange(len(low)) * n_slots + np.diff(offsets) - 1
        scores = _scored(block, rows)
        # Nothing below the least lower limit counts, nor below a full last slot's last row.
        least = np.maximum(low, best.limit[last])
        wanted = (labels != rows["label"])[:, None] & (scores <= limits[:, :1]) & (scores >= least[:, None])
        anchor, at = np.nonzero(wanted)
        values = scores[anchor, at].astype(np.int64)
        slots = slots_of(values, limits[anchor])
        best.add(anchor * n_slots + slots, values, _numbers(rows["id"])[at], _numbers(rows["nth"])[at])
    if best:
        yield flush()


# ---- tables --------------------------------------------------------------------------------------------------------


def _packed(rows: DataFrame, keys: list[str], fields: str, name: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.expr(f"collect_list(struct({fields})) as {name}"))


def _met(blocks: DataFrame, chunks: DataFrame, keys: list[str], n_parts: int) -> DataFrame:
    """Every block with every chunk (of equal ``keys``); blocks are copied to all parts, chunks lie in one."""
    copied = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    return copied.join(chunks, [*keys, "part"]).select("block", "anchors", "label", "rows")


def _staged_pairs(met: DataFrame, work: Callable, schema: str, label: str) -> DataFrame:
    """Run ``work`` on the pairs, few at a time as they are large, and write what it returns."""
    with batches_of(met.sparkSession, PAIRS_PER_BATCH):
        return stage(met.mapInArrow(work, schema), label)


def hard_negatives(rows: DataFrame, is_anchor: str, m: Mining = Mining()) -> DataFrame:
    """``rows``: id bigint, label bigint, vector array<bigint>, none null but ids. ``is_anchor``: SQL on them.

    Returns anchor_id, positive_id, rank, negative_id, positive_score and negative_score.
    """
    spark = rows.sparkSession
    ship(spark)
    table = stage(
        rows.selectExpr(
            f"coalesce(id, {NO_ID}L) as id", "label", "vector", f"coalesce({is_anchor}, false) as anchor",
            "monotonically_increasing_id() as nth",
        ),
        "vectors",
    )
    # Chunks and blocks are dealt by a hash of the row's place: even for any labels, however frequent.
    n_rows, n_anchors = table.selectExpr("count(*)", "count_if(anchor)").first()
    n_chunks, n_blocks = -(-n_rows // CHUNK_ROWS) or 1, -(-n_anchors // BLOCK_ANCHORS) or 1
    n_parts = max(-(-n_chunks // PART_CHUNKS), min(n_chunks, 2 * spark.sparkContext.defaultParallelism))
    dealt = lambda n: f"pmod(xxhash64(nth), {n}L)"
    chunks = stage(
        _packed(table.selectExpr("*", f"{dealt(n_chunks)} as chunk"), ["label", "chunk"], "nth, id, vector", "rows")
        .selectExpr("label", "rows", f"cast(pmod(chunk, {n_parts}) as int) as part"),
        "chunks",
    )
    anchors = table.where("anchor").selectExpr("*", f"{dealt(n_blocks)} as block")

    one_label = _packed(anchors, ["label", "block"], "nth, vector", "anchors").withColumn("block", F.struct("label", "block"))
    found = _staged_pairs(
        _met(one_label, chunks, ["label"], n_parts), lambda batches: _best_rows(batches, m.positives),
        "anchor bigint, score bigint, id bigint, row bigint", "positives",
    )
    nth = lambda keys: f"row_number() over (partition by {keys} order by score desc, id, row) as nth"
    # A percentage of 100 * hundreds + rest, rounded down or up; whole numbers that don't exceed the score.
    hundreds, rest = "(score - pmod(score, 100L)) div 100L", "pmod(score, 100L)"
    bounds = (
        f"struct(nth, score, id, {m.high_percent} * ({hundreds}) + {m.high_percent} * {rest} div 100L as high, "
        f"{m.low_percent} * ({hundreds}) + ({m.low_percent} * {rest} + 99L) div 100L as low)"
    )
    positives = stage(
        found.selectExpr("*", nth("anchor")).where(f"nth <= {m.positives}")
        .groupBy("anchor").agg(F.expr(f"sort_array(collect_list({bounds})) as positives")),
        "limits",
    )

    limited = anchors.join(positives.withColumnRenamed("anchor", "nth"), "nth").selectExpr(
        "block", "nth", "label", "vector", "positives.high as high", "array_min(positives.low) as low"
    )
    mixed = _packed(limited, ["block"], "nth, label, vector, high, low", "anchors")
    kept = _staged_pairs(
        _met(mixed, chunks, [], n_parts), lambda batches: _best_by_slot(batches, m.negatives, m.positives),
        "anchor bigint, slot bigint, score bigint, id bigint, row bigint", "slots",
    )
    slots = (
        kept.selectExpr("*", nth("anchor, slot")).where(f"nth <= {m.negatives}")
        .groupBy("anchor").agg(F.expr("sort_array(collect_list(struct(slot, nth, score, id))) as kept"))
    )
    own = "transform(filter(kept, x -> x.slot = j), x -> struct(x.score as score, x.id as id))"
    none = "cast(array() as array<struct<score: bigint, id: bigint>>)"
    # Element j of ``below``: the best rows of slot j and all behind it.
    below = (
        f"aggregate(reverse(sequence(0, size(positives) - 1)), cast(array() as array<array<struct<score: bigint, id: bigint>>>), "
        f"(done, j) -> concat(array(slice(concat({own}, coalesce(get(done, 0), {none})), 1, {m.negatives})), done))"
    )
    answered = positives.join(slots, "anchor").selectExpr("anchor", "positives", f"{below} as below").selectExpr(
        "anchor", "posexplode(positives) as (j, p)", "below"
    ).selectExpr("anchor", "p", "posexplode(filter(below[j], x -> x.score >= p.low)) as (k, n)")
    ids = table.where("anchor").selectExpr("nth as anchor", "id as anchor_id")
    some = lambda name: f"nullif({name}, {NO_ID}L)"
    return answered.join(ids, "anchor").selectExpr(
        f"{some('anchor_id')} as anchor_id", f"{some('p.id')} as positive_id", "cast(k + 1 as int) as rank",
        f"{some('n.id')} as negative_id", "p.score as positive_score", "n.score as negative_score",
    )


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """The rows that take part, with the query's labels and whole components: id, label, vector."""
    finite = "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return embeddings.where(f"label is not null and embedding is not null and {finite}").selectExpr(
        "cast(vec_id as bigint) as id",
        "if(vec_id % 7 = 0, (cast(label as bigint) + 1) % 10, cast(label as bigint)) as label",
        "transform(embedding, x -> floor(256D * x)) as vector",
    )


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), "id % 50 = 0")


ORACLE_SQL = """
with held as (
    select vec_id,
        case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select a.vec_id as anchor_id, r.vec_id as other_id, a.label = r.label as same,
        list_inner_product(a.v, r.v)::bigint as score
    from held a join held r on a.vec_id % 50 = 0 and r.vec_id <> a.vec_id
),
positives as (
    select anchor_id, other_id as positive_id, score as positive_score
    from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, p.positive_id,
    row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.other_id)::int as rank,
    n.other_id as negative_id, p.positive_score, n.score as negative_score
from positives p join scored n
    on n.anchor_id = p.anchor_id and not n.same
    and 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score
qualify rank <= 3
"""

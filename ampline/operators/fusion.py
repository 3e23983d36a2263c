"""Fusion of ignition events: drop an event less than 10 s after the last kept one of its kind.

A row with another event than its predecessor, or at least 10 s after it, is kept whatever came
before: it heads an independent run. The rows of a run less than 10 s after its head are dropped,
so only the rest of longer runs need a walk from kept event to kept event. Runs are cut at
slice borders; rows that go on with the run of the previous slice need only the time of the
last event kept there.

A run that fills whole slices turns each of them into a function from the last kept time before
it to the last kept time in it. Blocks of neighbouring slices are composed into one function,
blocks of blocks again, until a run has one block; then the known first time goes back down,
from each block to the slices in it. No group holds more than ``chain_slices`` slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampline.config import Params
from ampline.functions.scalars import SECOND, file_chunk, micros, no_chunk
from ampline.operators.ranking import numbered
from ampline.operators.scan import scanned
from ampline.operators.slices import UP_TO_HERE, VEHICLE, HotCells, in_slice, scan_block, with_context, with_slice
from ampline.staging import counted, stage

# At equal times the source with the lower number comes first.
PRIORITY = "case source when 'TLM' then 0 when 'TRG' then 1 when 'SYN' then 2 end"
ORDER = ["us", "prio", "ord1", "ord2"]


def _single_copies(synthetic: DataFrame) -> DataFrame:
    """Equal synthetic events stand next to each other at their instant, so all but the first go.

    Done by a grouping, which shrinks a large group of copies before the shuffle.
    """
    return synthetic.groupBy("vehicle_id", "event", "event_ts", "source", "ord1").agg(F.expr("min(ord2) as ord2"))


def keep_spaced(times: str, last_us: str, gap: int) -> str:
    """Times (sorted) at least ``gap`` microseconds after the previously kept one; few, as they are so far apart."""
    return (
        f"aggregate({times}, named_struct('last', cast({last_us} as bigint), 'kept', slice({times}, 1, 0)), "
        f"(s, x) -> if(s.last is null or x - s.last >= {gap}, "
        f"named_struct('last', x, 'kept', concat(s.kept, array(x))), s), s -> s.kept)"
    )


def _open_rows(recorded: DataFrame, synthetic: DataFrame, hot: HotCells | None, p: Params) -> tuple[DataFrame, int]:
    """Heads of runs and the rows that a head of their slice does not settle, and the number of rows without a head there.

    ``opens`` marks heads; ``head_us`` is the time of the run's head, NULL in a run that began
    in an earlier slice.
    """
    gap = p.near_dup_gap_sec * SECOND
    single = recorded.unionByName(_single_copies(synthetic)).selectExpr(
        "*", f"{micros('event_ts')} as us", f"{PRIORITY} as prio"
    )
    chunk = f"if(source = 'TRG', {no_chunk('prio')}, {file_chunk(single, 'ord2', 'prio')})"
    placed = stage(with_slice(single, chunk, hot, p), "fusion-input")
    rows = (
        with_context(placed, ORDER, before={"carried": "struct(event, us)"}, block_rows=scan_block(hot, p))
        .selectExpr(
            "*", f"coalesce(lag(event) {in_slice(ORDER)}, carried.event) as prev_event",
            f"coalesce(lag(us) {in_slice(ORDER)}, carried.us) as prev_us",
        )
        .selectExpr("*", f"prev_us is null or prev_event <> event or us - prev_us >= {gap} as opens")
        .selectExpr("*", f"last(if(opens, us, null)) ignore nulls {in_slice(ORDER, frame=UP_TO_HERE)} as head_us")
        .where(f"opens or head_us is null or us - head_us >= {gap}")
    )
    table, found = counted(
        rows.drop("carried", "prev_event", "prev_us"), "fusion-rows", {"headless": "count_if(head_us is null)"}
    )
    return table, found["headless"]


# ---- long runs ----------------------------------------------------------------------------------------------------

RUN = ["vehicle_id", "start_us"]  # a vehicle's run by its last kept time before the slices that it fills
STEPS = "seq bigint, limit_us bigint, entry_us array<bigint>, exit_us array<bigint>"
SEEDS = "vehicle_id string, start_us bigint, seq bigint, seed_us bigint"


@dataclass(frozen=True)
class Steps:
    """From the last kept time before a stretch of a run to the last one in it.

    The first of ``entry`` that is at least ``gap`` later than the time before gives the ``exit`` at its place; where
    there is none, nothing of the stretch is kept. A time before lies before the stretch, so no entry much behind
    ``limit``, the stretch's first time and the gap, is needed.
    """

    limit: int
    entry: np.ndarray
    exit: np.ndarray

    def __call__(self, before: np.ndarray, gap: int) -> np.ndarray:
        at = np.searchsorted(self.entry, before + gap)
        return np.append(self.exit, 0)[at] * (at < len(self.entry)) + before * (at >= len(self.entry))


def steps_of(us: np.ndarray, gap: int) -> Steps:
    """The function of one slice's times."""
    n = len(us)
    jump = np.searchsorted(us, us + gap)
    end = np.where(jump < n, jump, np.arange(n))
    while True:  # each round doubles the number of jumps taken
        further = end[end]
        if np.array_equal(further, end):
            return _shortened(int(us[0]) + gap, us, us[end])
        end = further


def _shortened(limit: int, entry: np.ndarray, exit: np.ndarray) -> Steps:
    """Without entries that no time before can reach, and with the last one only of those that lead to one exit."""
    n = int(np.searchsorted(entry, limit)) + 1
    entry, exit = entry[:n], exit[:n]
    last = np.append(exit[1:] != exit[:-1], True)
    return Steps(limit, entry[last], exit[last])


def composed(steps: list[Steps], gap: int) -> Steps:
    """The function of a stretch from those of its pieces, in order."""
    whole = steps[0]
    for piece in steps[1:]:
        further = piece.entry > whole.entry[-1]  # reached by a time that keeps nothing of the pieces so far
        whole = _shortened(
            whole.limit, np.concatenate((whole.entry, piece.entry[further])),
            np.concatenate((piece(whole.exit, gap), piece.exit[further])),
        )
    return whole


def walked(steps: list[Steps | None], seed: int, gap: int) -> list[int]:
    """The last kept time before each piece."""
    seeds, last = [], np.array([seed])
    for piece in steps:
        seeds.append(int(last[0]))
        if piece is not None:
            last = piece(last, gap)
    return seeds


def _links(batch: pa.RecordBatch, row: int) -> tuple[list[int], list[Steps | None]]:
    links = batch.column("links")[row].values
    seqs, limits, entries, exits = (links.field(name) for name in ("seq", "limit_us", "entry_us", "exit_us"))
    steps = [
        Steps(limits[i].as_py(), np.asarray(entries[i].values), np.asarray(exits[i].values)) if limits[i].is_valid else None
        for i in range(len(links))
    ]
    return seqs.to_pylist(), steps


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64())}
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kinds[kind]) for column, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields]
    )


def _each_row(work: Callable[[pa.RecordBatch, int], list[tuple]], schema: str):
    """An Arrow function that turns each row into the rows that ``work`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _table([out for row in range(batch.num_rows) for out in work(batch, row)], schema)

    return run


def _slice_steps(covered: DataFrame, gap: int) -> DataFrame:
    def work(batch: pa.RecordBatch, row: int) -> list[tuple]:
        vehicle, start, seq = (batch.column(i)[row].as_py() for i in range(3))
        steps = steps_of(np.asarray(batch.column("times")[row].values), gap)
        return [(vehicle, start, seq, steps.limit, steps.entry, steps.exit)]

    schema = f"vehicle_id string, start_us bigint, {STEPS}"
    return covered.select(*RUN, "seq", "times").mapInArrow(_each_row(work, schema), schema)


def _in_blocks(links: DataFrame, block: str) -> DataFrame:
    """The links of a run's blocks as one list each."""
    return links.groupBy(*RUN, F.expr(block).alias("block")).agg(
        F.expr("sort_array(collect_list(struct(seq, limit_us, entry_us, exit_us))) as links")
    )


def _composed_blocks(links: DataFrame, size: int, gap: int) -> DataFrame:
    def work(batch: pa.RecordBatch, row: int) -> list[tuple]:
        vehicle, start, block = (batch.column(i)[row].as_py() for i in range(3))
        steps = [s for s in _links(batch, row)[1] if s is not None]
        whole = composed(steps, gap) if steps else None
        return [(vehicle, start, block, whole.limit, whole.entry, whole.exit) if whole else (vehicle, start, block, None, None, None)]

    schema = f"vehicle_id string, start_us bigint, {STEPS}"
    return _in_blocks(links, f"seq div {size}").mapInArrow(_each_row(work, schema), schema)


def _walked_blocks(blocks: DataFrame, gap: int) -> DataFrame:
    """``blocks``: a run's blocks with their links and their ``seed_us``. Returns the seeds of the links."""

    def work(batch: pa.RecordBatch, row: int) -> list[tuple]:
        vehicle, start, seed = (batch.column(name)[row].as_py() for name in (*RUN, "seed_us"))
        seqs, steps = _links(batch, row)
        return [(vehicle, start, seq, last) for seq, last in zip(seqs, walked(steps, seed, gap))]

    return blocks.mapInArrow(_each_row(work, SEEDS), SEEDS)


def _chained(links: DataFrame, size: int, gap: int) -> DataFrame:
    """Seeds of all links of all runs, by rounds of blocks of ``size`` neighbours."""
    levels = [links]
    while True:
        reach = levels[-1].groupBy(*RUN).agg(F.expr("max(seq) - min(seq) as reach")).agg(F.max("reach")).first()[0]
        if reach is None or reach < size:
            break
        levels.append(stage(_composed_blocks(levels[-1], size, gap), "fusion-blocks"))
    top = _in_blocks(levels[-1], "0L").withColumn("seed_us", F.col("start_us"))
    seeds = _walked_blocks(top, gap)
    for level in reversed(levels[:-1]):
        outer = stage(seeds, "fusion-seeds").withColumnRenamed("seq", "block")
        seeds = _walked_blocks(_in_blocks(level, f"seq div {size}").join(outer, [*RUN, "block"]), gap)
    return seeds


def _through_covered(chain: DataFrame, groups: DataFrame, p: Params, gap: int) -> DataFrame:
    """Seeds behind slices filled by one unbroken run: what leaves them depends on what enters."""
    # The covered slices of a run and the one after them have consecutive numbers.
    parts = chain.where("covered or after_covered")
    links = stage(numbered(parts, ["vehicle_id", "slice"], "seq"), "fusion-links")
    steps = _slice_steps(links.where("covered").join(groups, ["vehicle_id", "slice"]), gap)
    ends = links.where("not covered").selectExpr(
        *RUN, "seq", "cast(null as bigint) as limit_us", "cast(null as array<bigint>) as entry_us",
        "cast(null as array<bigint>) as exit_us",
    )
    seeds = _chained(stage(steps.unionByName(ends), "fusion-steps"), p.chain_slices, gap)
    return links.where("after_covered").select("vehicle_id", "slice", "seq").join(
        seeds.select("seq", "seed_us"), "seq"
    ).select("vehicle_id", "slice", "seed_us")


def _seeds(rows: DataFrame, kept: DataFrame, going_on: DataFrame, hot: HotCells | None, p: Params, gap: int) -> DataFrame:
    """Last kept time before each slice that goes on with a run: vehicle_id, slice, seed_us."""
    tails = kept.groupBy("vehicle_id", "slice").agg(F.expr("max(us) as tail_us"))
    ends = rows.groupBy("vehicle_id", "slice").agg(
        F.expr("max(head_us is null) as goes_on"), F.expr("not max(opens) as covered")
    )
    slices, block_rows = ends.join(tails, ["vehicle_id", "slice"], "left"), scan_block(hot, p)
    if block_rows is not None:
        slices = stage(slices, "fusion-ends")
    chain = scanned(
        slices, VEHICLE, "slice", {"start_us": "tail_us", "before_covered": "covered"}, block_rows=block_rows
    ).where("goes_on").selectExpr(
        "vehicle_id", "slice", "covered", "start_us", "coalesce(before_covered, false) as after_covered"
    )
    chain, found = counted(chain, "fusion-chain", {"covered": "count_if(covered)"})
    seeds = chain.where("not after_covered").selectExpr("vehicle_id", "slice", "start_us as seed_us")
    if not found["covered"]:
        return seeds
    return seeds.unionByName(_through_covered(chain, going_on, p, gap))


def fuse(recorded: DataFrame, synthetic: DataFrame, hot: HotCells | None, p: Params) -> DataFrame:
    """Kept events: vehicle_id, event, event_ts, source and their place (prio, ord1, ord2).

    ``recorded``: events of TLM and TRG; ``synthetic``: those of SYN, all of one kind.
    """
    gap = p.near_dup_gap_sec * SECOND
    rows, headless = _open_rows(recorded, synthetic, hot, p)
    columns = ["vehicle_id", "slice", *ORDER, "event", "event_ts", "source"]
    heads = rows.where("opens").select(columns)
    # Of the rows of one time only the first can be kept, and runs share no time, so times are enough to walk.
    item = f"struct({', '.join(ORDER[1:])}, event, event_ts, source)"
    firsts = rows.where("not opens").groupBy("vehicle_id", "slice", "head_us", "us").agg(F.expr(f"min({item}) as item"))
    firsts = stage(firsts, "fusion-times")
    groups = firsts.groupBy("vehicle_id", "slice", "head_us").agg(F.expr("sort_array(collect_list(us)) as times"))

    def walk(undecided: DataFrame, seed: str) -> DataFrame:
        times = undecided.selectExpr("vehicle_id", "slice", f"explode({keep_spaced('times', seed, gap)}) as us")
        return times.join(firsts, ["vehicle_id", "slice", "us"]).selectExpr("vehicle_id", "slice", "us", "item.*").select(columns)

    kept = heads.unionByName(walk(groups.where("head_us is not null"), "head_us"))
    if headless:
        going_on = groups.where("head_us is null")
        seeded = going_on.join(_seeds(rows, kept, going_on, hot, p, gap), ["vehicle_id", "slice"])
        kept = kept.unionByName(walk(seeded, "seed_us"))
    return kept.select("vehicle_id", "event", "event_ts", "source", "prio", "ord1", "ord2")

"""Ordered work on long per-vehicle sequences, cut into slices.

A window over a whole vehicle is one task's work, however much that vehicle sent. Here a
sequence is cut by time into slices, windows run per (vehicle, slice), and what a slice must
know of its neighbours comes from one small row per slice. Every slice number grows with the
sequence order, so neighbours in slice order are neighbours in time.

A vehicle-hour with more than ``max_slice_rows`` rows is cut by a tree of times: it is cut into
minutes, and only those of its minutes that are still too large into seconds, of these the large
ones into milliseconds, and so on to microseconds. A single instant that is itself too large is
cut into stretches of input order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampline.config import Params
from ampline.functions.scalars import SECOND, micros, no_chunk
from ampline.operators.scan import scanned
from ampline.staging import stage

VEHICLE = ("vehicle_id",)
HOUR = 3600
#: Pieces of a crowded hour, from the smallest: name of the list of crowded ones, and length in microseconds.
PIECES = (("instants", 1), ("millis", 1000), ("seconds", SECOND), ("minutes", 60 * SECOND))


@dataclass(frozen=True)
class HotCells:
    table: DataFrame  # vehicle_id, cell, and the starts of its crowded pieces: instants, millis, seconds, minutes
    broadcast: bool


def slice_start(us: str, seconds: int) -> str:
    return f"(({us}) - pmod({us}, {seconds * SECOND}L))"


def _piece_start(us: str, length: int) -> str:
    return f"greatest(cell, {us} - pmod({us}, {length}L))"


def find_hot_cells(rows: DataFrame, p: Params) -> HotCells | None:
    """Vehicle-hours with too many rows. ``rows``: vehicle_id, event_ts; counted map-side first."""
    placed = rows.selectExpr("vehicle_id", f"{micros('event_ts')} as us").selectExpr(
        "*", f"{slice_start('us', p.slice_sec)} as cell"
    )
    crowded = f"count > {p.max_slice_rows}"
    counts = placed.groupBy("vehicle_id", "cell").count().where(crowded).select("vehicle_id", "cell")
    if counts.isEmpty():
        return None
    cells = stage(counts, "hot-cells")
    small = cells.count() <= p.broadcast_rows
    inside = placed.join(F.broadcast(cells) if small else cells, ["vehicle_id", "cell"])
    nodes = inside.withColumnRenamed("us", "start").groupBy("vehicle_id", "cell", "start").count()
    # Up the tree of times. Crowded pieces are few, as each holds more than max_slice_rows rows.
    names = [name for name, _ in PIECES]
    for i, name in enumerate(names):
        marked = nodes.selectExpr("*", f"if({crowded}, array(start), cast(array() as array<bigint>)) as {name}")
        outer = [] if i + 1 == len(names) else [F.expr(_piece_start("start", PIECES[i + 1][1])).alias("start")]
        nodes = marked.groupBy("vehicle_id", "cell", *outer).agg(
            F.sum("count").alias("count"), *[F.expr(f"flatten(collect_list({n})) as {n}") for n in names[: i + 1]]
        )
    return HotCells(stage(nodes.drop("count"), "hot-pieces"), small)


def with_slice(rows: DataFrame, chunk: str, hot: HotCells | None, p: Params) -> DataFrame:
    """Add ``slice`` to rows with ``vehicle_id`` and ``us``.

    ``chunk`` must grow with the order of rows of equal time; only hot instants use it.
    """
    hour = slice_start("us", p.slice_sec)
    if hot is None:
        return rows.selectExpr("*", f"{hour} as slice")
    marked = rows.selectExpr("*", f"{hour} as cell", f"{chunk} as chunk").join(
        F.broadcast(hot.table) if hot.broadcast else hot.table, ["vehicle_id", "cell"], "left"
    )
    # The largest piece around the row that is not crowded; in a cell that is not crowded, the cell.
    whole = " ".join(
        f"when not array_contains({name}, {_piece_start('us', length)}) then {_piece_start('us', length)}"
        for name, length in reversed(PIECES[1:])
    )
    start = f"case when minutes is null then cell {whole} else us end"
    at_hot = "coalesce(array_contains(instants, us), false)"
    place = f"named_struct('t', {start}, 'chunk', if({at_hot}, chunk, {no_chunk()})) as slice"
    return marked.selectExpr("*", place).drop("cell", "chunk", *[name for name, _ in PIECES])


def scan_block(hot: HotCells | None, p: Params) -> int | None:
    """Rows of a block when slices are scanned; None where slices are hours, so few that a window holds a vehicle's."""
    return None if hot is None and p.slice_sec >= HOUR else p.scan_block_rows


def in_slice(order: list[str], key: tuple[str, ...] = VEHICLE, frame: str = "") -> str:
    """The ``over (…)`` clause of a window inside a slice."""
    return f"over (partition by {', '.join(key)}, slice order by {', '.join(order)} {frame})"


UP_TO_HERE = "rows between unbounded preceding and current row"


def with_context(
    rows: DataFrame,
    order: list[str],
    before: dict[str, str] | None = None,
    after: dict[str, str] | None = None,
    key: tuple[str, ...] = VEHICLE,
    block_rows: int | None = None,
) -> DataFrame:
    """Add values from outside the slice: per name the last non-null one of the earlier slices
    (``before``) or the first of the later ones (``after``).

    One row per slice is scanned, in blocks if ``block_rows`` is given.
    """
    before, after = before or {}, after or {}
    place = f"struct({', '.join(order)})"
    end = lambda pick, name, value: F.expr(f"{pick}({value}, if(({value}) is not null, {place}, null)) as own_{name}")
    ends = rows.groupBy(*key, "slice").agg(
        *[end("max_by", n, v) for n, v in before.items()], *[end("min_by", n, v) for n, v in after.items()]
    )
    if block_rows is not None:
        ends = stage(ends, "slice-ends")
    own = lambda names: {n: f"own_{n}" for n in names}
    context = scanned(ends, key, "slice", own(before), own(after), block_rows).select(*key, "slice", *before, *after)
    return rows.join(context, [*key, "slice"])

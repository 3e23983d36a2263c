"""Charging sessions: battery rises between neighbouring events, merged when close."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampline.config import Params
from ampline.functions.scalars import SECOND, file_chunk, micros, no_chunk, round2, seconds_between
from ampline.operators.scan import scanned
from ampline.operators.slices import UP_TO_HERE, VEHICLE, HotCells, in_slice, scan_block, with_context, with_slice
from ampline.staging import stage

ORDER = ["us", "kind", "prio", "ord1", "ord2"]
SESSION_COLUMNS = [
    "vehicle_id", "start_ts", "end_ts", "delta_battery_pct", "start_battery_pct",
    "end_battery_pct", "duration_sec", "ignition_state",
]
STATES = "array('unknown', 'ignitionOn', 'ignitionOff')"


def event_sequence(ignition: DataFrame, status: DataFrame) -> DataFrame:
    """Ignition (kind 0) and status events (kind 1) of all vehicles with their tie order."""
    parts = ["vehicle_id", "event", "event_ts"]
    ign = ignition.selectExpr(*parts, "0 as kind", "prio", "ord1", "ord2")
    return ign.unionByName(status.selectExpr(*parts, "1 as kind", "0 as prio", "ord1", "ord2"))


def with_battery_column(events: DataFrame) -> DataFrame:
    """Events with ``battery_pct``, NULL in all rows if they have none."""
    if "battery_pct" in events.columns:
        return events
    return events.selectExpr("*", "cast(null as double) as battery_pct")


def charge_pairs(candidates: DataFrame, hot: HotCells | None, p: Params) -> DataFrame:
    """Each event with its immediate successor, both with a battery level and later in time.

    ``candidates``: an event sequence with ``battery_pct`` attached; without it, all levels are NULL.
    """
    candidates = with_battery_column(candidates)
    prio = "kind * 4 + prio"
    chunk = f"if(kind = 1 or prio = 1, {no_chunk(prio)}, {file_chunk(candidates, 'ord2', prio)})"
    placed = stage(
        with_slice(candidates.selectExpr("*", f"{micros('event_ts')} as us"), chunk, hot, p), "candidates"
    )
    me = "struct(event_ts, battery_pct)"
    ignition = "if(kind = 0, event, null)"
    context = with_context(
        placed, ORDER, before={"state_before": ignition}, after={"first_after": me}, block_rows=scan_block(hot, p)
    )
    paired = context.selectExpr(
        "vehicle_id", "event_ts", "battery_pct",
        f"coalesce(lead({me}) {in_slice(ORDER)}, first_after) as to",
        f"coalesce(last({ignition}) ignore nulls {in_slice(ORDER, frame=UP_TO_HERE)}, state_before, 'unknown') as state",
    )
    return paired.where(
        "battery_pct is not null and to.battery_pct is not null and to.event_ts > event_ts"
    ).selectExpr(
        "vehicle_id", "event_ts as start_ts", "to.event_ts as end_ts",
        "battery_pct as start_pct", "to.battery_pct as end_pct", "to.battery_pct - battery_pct as delta_pct",
        f"{seconds_between('event_ts', 'to.event_ts')} as duration_sec", "state as ignition_state",
    )


def sessions_before_merge(pairs: DataFrame, p: Params) -> DataFrame:
    needed = f"if(ignition_state = 'ignitionOn', {p.rise_ign_on}D, {p.rise_ign_off}D)"
    return pairs.where(f"delta_pct >= {needed}").selectExpr(
        "vehicle_id", "start_ts", "end_ts",
        f"{round2('delta_pct')} as delta_battery_pct",
        f"{round2('start_pct')} as start_battery_pct",
        f"{round2('end_pct')} as end_battery_pct",
        "duration_sec", "ignition_state",
    )


def merge_sessions(raw: DataFrame, hot: HotCells | None, p: Params) -> DataFrame:
    """Join sessions at most ``merge_gap_sec`` apart. Delta and times of a joined one are
    recomputed from its ends; its state is that of the first.

    ``raw``: sessions of a vehicle must not overlap, which neighbour pairs never do.
    """
    apart = p.merge_gap_sec * SECOND
    placed = stage(
        with_slice(
            raw.selectExpr("*", f"{micros('start_ts')} as us", f"{micros('end_ts')} as end_us"), no_chunk(), hot, p
        ),
        "sessions",
    )
    # ``opens``: start of a joined session, known inside a slice for all rows but its first.
    inner = placed.selectExpr("*", f"lag(end_us) {in_slice(['us'])} as prev_end").selectExpr(
        "*", f"if(us - prev_end > {apart}, us, null) as opens"
    )
    # A slice is summed up by its first start, last end and last opening; whether its head opens a joined session
    # hangs on the last end before it, and then the last opening before it is known.
    block_rows = scan_block(hot, p)
    ends = inner.groupBy("vehicle_id", "slice").agg(
        F.expr("min(us) as first_us"), F.expr("max(end_us) as last_end"), F.expr("max(opens) as last_opens")
    )
    if block_rows is not None:
        ends = stage(ends, "session-ends")
    heads = scanned(ends, VEHICLE, "slice", {"carried_end": "last_end"}, block_rows=block_rows).selectExpr(
        "*", f"if(carried_end is null or first_us - carried_end > {apart}, first_us, null) as head_opens"
    ).selectExpr("*", "coalesce(last_opens, head_opens) as own_opens")
    if block_rows is not None:
        heads = stage(heads, "session-heads")
    context = scanned(heads, VEHICLE, "slice", {"carried_opens": "own_opens"}, block_rows=block_rows).select(
        "vehicle_id", "slice", "head_opens", "carried_opens"
    )
    seen = f"last(opens) ignore nulls {in_slice(['us'], frame=UP_TO_HERE)}"
    merged = (
        inner.join(context, ["vehicle_id", "slice"])
        .selectExpr("*", f"coalesce({seen}, head_opens, carried_opens) as island")
        .selectExpr("*", f"array_position({STATES}, ignition_state) as code")
        .groupBy("vehicle_id", "island")
        .agg(*[F.expr(x) for x in (
            "count(*) as n", "min(us) as us", "max(end_us) as end_us", "min_by(delta_battery_pct, us) as delta",
            "min_by(start_battery_pct, us) as start_battery_pct",
            "max_by(end_battery_pct, us) as end_battery_pct", "min_by(code, us) as code",
            "min(start_ts) as start_ts", "max(end_ts) as end_ts",
        )])
    )
    return merged.selectExpr(
        "vehicle_id", "start_ts", "end_ts",
        f"if(n = 1, delta, {round2('end_battery_pct - start_battery_pct')}) as delta_battery_pct",
        "start_battery_pct", "end_battery_pct", "(end_us - us) / 1e6D as duration_sec",
        f"{STATES}[code - 1] as ignition_state",
    )


def charging_events(merged: DataFrame, p: Params) -> DataFrame:
    return merged.where(f"duration_sec >= {p.min_session_sec}")

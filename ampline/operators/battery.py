"""Charge-status events, the battery timeline, and the nearest reading of each event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampline.config import Params
from ampline.functions.scalars import SECOND, micros, no_chunk, ntz_from_micros, to_number
from ampline.operators.slices import HotCells, find_hot_cells, in_slice, scan_block, slice_start, with_context, with_slice
from ampline.staging import stage

READING = "struct<us: bigint, battery_pct: double>"


def charging_status(mapped: DataFrame) -> DataFrame:
    """Plug events with the two spellings of abort and complete made one."""
    return mapped.where("NAME = 'EV_CHARGE_STATE' and vehicle_id is not null").selectExpr(
        "vehicle_id",
        "case VAL when 'Aborted' then 'Abort' when 'Completed' then 'Complete' else VAL end as event",
        "CTS as event_ts", "PNID as ord1", "row_ord as ord2",
    )


def battery_timeline(clean_tlm: DataFrame, mapped_trg: DataFrame) -> DataFrame:
    tlm = clean_tlm.where("VEHICLE_ID is not null and EV_BATTERY_LEVEL is not null").selectExpr(
        "VEHICLE_ID as vehicle_id", "TIMESTAMP as ts", "EV_BATTERY_LEVEL as battery_pct",
        "'TLM' as source", "0L as ord1", "row_ord as ord2",
    )
    trg = mapped_trg.where("NAME = 'CHARGE_STATE' and vehicle_id is not null").selectExpr(
        "vehicle_id", "CTS as ts", f"{to_number('VAL')} as battery_pct",
        "'TRG' as source", "PNID as ord1", "row_ord as ord2",
    ).where("battery_pct is not null")
    capped = "if(battery_pct > 100, 100D, battery_pct) as battery_pct"
    return tlm.unionByName(trg.selectExpr("vehicle_id", "ts", capped, "source", "ord1", "ord2"))


def _in_hours(readings: DataFrame, probes: DataFrame, p: Params) -> DataFrame:
    """``event_us``, the next reading and the prior one, where no hour is crowded.

    An event is looked up in the hours that its window touches, so that one sort of an hour serves both look-ups: by the
    event's time, and by the begin of the whole second that holds the last reading before it.
    """
    window = p.battery_window_sec
    cell = lambda us: slice_start(us, p.slice_sec)
    first, last = f"event_us - {window * SECOND}", f"event_us + {(window + 1) * SECOND}"
    line = readings.selectExpr(
        "vehicle_id", f"{cell('us')} as slice", "us", "cast(null as bigint) as event_us", "struct(us, battery_pct) as reading"
    ).unionByName(probes.selectExpr(
        "vehicle_id", f"explode(sequence({cell(first)}, {cell(last)}, {p.slice_sec * SECOND}L)) as slice",
        "event_us as us", "event_us", f"cast(null as {READING}) as reading",
    ))
    # At equal times events sort before readings.
    over = lambda at: in_slice([at, "reading is not null"])
    return (
        line.selectExpr(
            "*", f"lag(reading.us) ignore nulls {over('us')} as before_us", f"lead(reading) ignore nulls {over('us')} as next"
        )
        .selectExpr("*", f"coalesce({_second_start()}, us) as at")
        .selectExpr("*", f"lead(reading) ignore nulls {over('at')} as prior")
        .where("event_us is not null")
    )


def _second_start() -> str:
    """Begin of the whole second, counted back from the event, that holds the last reading before it."""
    return f"event_us - (event_us - before_us + {SECOND - 1}) div {SECOND} * {SECOND}"


def _first_from(readings: DataFrame, probes: DataFrame, hot: HotCells | None, p: Params) -> DataFrame:
    """``probes`` (vehicle_id, event_us, at, …) with the last reading before ``at`` and the first one from ``at`` on.

    Readings and probes lie in the same slices, each in one. A slice's nearest readings outside it come as sentinels
    from the scan over slices, so no probe is copied.
    """
    held = [c for c in probes.columns if c != "vehicle_id"]
    line = readings.selectExpr("vehicle_id", "us", "struct(us, battery_pct) as reading", "null as probe").unionByName(
        probes.selectExpr("vehicle_id", "at as us", f"cast(null as {READING}) as reading", f"struct({', '.join(held)}) as probe")
    )
    # One row of a reading or of a probe at each instant is left, so instants need no cut.
    placed = stage(with_slice(line, no_chunk(), hot, p), "look-up")
    order = ["us", "reading is not null"]
    sentinels = with_context(
        placed, order, before={"earlier": "reading.us"}, after={"later": "reading"}, block_rows=scan_block(hot, p)
    )
    return sentinels.selectExpr(
        "vehicle_id", "probe",
        f"coalesce(lag(reading.us) ignore nulls {in_slice(order)}, earlier) as before_us",
        f"coalesce(lead(reading) ignore nulls {in_slice(order)}, later) as found",
    ).where("probe is not null").select("vehicle_id", "probe.*", "before_us", "found")


def _by_sentinels(readings: DataFrame, probes: DataFrame, hot: HotCells, p: Params) -> DataFrame:
    """The same as ``_in_hours`` where hours are crowded: two look-ups, each in slices of bounded size."""
    near = _first_from(readings, probes.selectExpr("*", "event_us as at"), hot, p).drop("at").withColumnRenamed("found", "next")
    near = stage(near, "next-readings")
    before = near.where("before_us is not null").selectExpr("vehicle_id", "event_us", f"{_second_start()} as at")
    prior = _first_from(readings, before, hot, p).selectExpr("vehicle_id", "event_us", "found as prior")
    return near.join(prior, ["vehicle_id", "event_us"], "left")


def nearest_readings(events: DataFrame, timeline: DataFrame, p: Params, crowded: bool | None = None) -> DataFrame:
    """Nearest reading per distinct (vehicle_id, event_ts) that has one in the window.

    ``crowded``: whether a vehicle-hour may have more than ``max_slice_rows`` rows of the timeline; counted if not given.

    The distance is the difference floored to seconds, the later reading wins a tie, then the
    first in timeline order. Hence the winner after the event is the first reading at or after
    it; the winner before is the first reading of the whole second (counted back from the
    event) that holds the last reading before it. Both are neighbours in one sorted sequence
    of readings and events, so no pairs are formed.
    """
    window = p.battery_window_sec
    # Of readings of one instant only the first can win; they shrink before the shuffle.
    readings = (
        timeline.selectExpr("vehicle_id", f"{micros('ts')} as us", "battery_pct", "struct(source, ord1, ord2) as place")
        .groupBy("vehicle_id", "us").agg(F.expr("min_by(battery_pct, place) as battery_pct"))
    )
    probes = events.selectExpr("vehicle_id", f"{micros('event_ts')} as event_us").distinct()
    if crowded is None:
        crowded = find_hot_cells(timeline.selectExpr("vehicle_id", "ts as event_ts"), p) is not None
    if not crowded:
        looked = _in_hours(readings, probes, p)
    else:
        # Crowded by instants: those of readings, and of events, which may be many where readings are few.
        readings, probes = stage(readings, "readings"), stage(probes, "probes")
        instants = readings.select("vehicle_id", "us").unionByName(probes.selectExpr("vehicle_id", "event_us as us"))
        hot = find_hot_cells(instants.selectExpr("vehicle_id", f"{ntz_from_micros('us')} as event_ts"), p)
        looked = _by_sentinels(readings, probes, hot, p)
    choice = lambda distance, side, hit: (
        f"if({distance} <= {window}, named_struct('distance', {distance}, 'side', {side}, "
        f"'us', {hit}.us, 'battery_pct', {hit}.battery_pct), null)"
    )
    ahead = f"(next.us - event_us) div {SECOND}"
    back = f"(event_us - before_us + {SECOND - 1}) div {SECOND}"
    return (
        looked.selectExpr("vehicle_id", "event_us", f"least({choice(ahead, 0, 'next')}, {choice(back, 1, 'prior')}) as best")
        .where("best is not null")
        .groupBy("vehicle_id", "event_us").agg(F.expr("min(best) as best"))
        .selectExpr(
            "vehicle_id", f"{ntz_from_micros('event_us')} as event_ts",
            "best.battery_pct as battery_pct", f"{ntz_from_micros('best.us')} as battery_ts",
        )
    )


def attach_battery(events: DataFrame, timeline: DataFrame, p: Params, crowded: bool | None = None) -> DataFrame:
    """Events with battery_pct and battery_ts, NULL where no reading is near."""
    return events.join(nearest_readings(events, timeline, p, crowded), ["vehicle_id", "event_ts"], "left")


def association_rate(events: DataFrame) -> DataFrame:
    return events.selectExpr("count(battery_pct) as associated", "count(*) as total").selectExpr(
        "*", "if(total > 0, 100 * associated / total, 0D) as pct"
    )

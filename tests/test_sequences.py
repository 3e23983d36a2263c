"""Ordered steps against brute force on random input, under many ways of cutting sequences."""

import random

import pytest

from ampline.config import Params
from ampline.functions.scalars import micros, ntz_from_micros
from ampline.operators.battery import attach_battery, nearest_readings
from ampline.operators.charging import charge_pairs, charging_events, merge_sessions, sessions_before_merge
from ampline.operators.fusion import fuse
from ampline.operators.ignition import ignition_changes
from ampline.operators.slices import find_hot_cells
from tests import brute

S = brute.SECOND
BASE = 1_704_067_200 * S

# Default slices, slices of a few rows, and crowded slices cut further.
CUTS = [
    Params(),
    Params(slice_sec=15),
    Params(slice_sec=3),
    Params(slice_sec=600, max_slice_rows=4),
    Params(slice_sec=20, max_slice_rows=1),
    Params(slice_sec=600, max_slice_rows=4, broadcast_rows=0),
]


def hot_cells(df, p):
    return find_hot_cells(df.select("vehicle_id", "event_ts"), p)


def frame(spark, rows, schema, time="us", name="event_ts"):
    return spark.createDataFrame(rows, schema).selectExpr("*", f"{ntz_from_micros(time)} as {name}").drop(time)


def fuse_all(df, hot, p):
    return fuse(df.where("source <> 'SYN'"), df.where("source = 'SYN'"), hot, p)


def random_times(rng, n, span, grain):
    times, at = [], BASE
    for _ in range(n):
        at += rng.choice([0, 0, rng.randrange(0, span, grain), rng.randrange(0, 3 * span, grain)])
        times.append(at)
    rng.shuffle(times)
    return times


@pytest.mark.parametrize("p", CUTS)
def test_status_changes(spark, p):
    rng = random.Random(1)
    rows = []
    for vehicle in "abc":
        for source in ("TLM", "TRG"):
            for i, us in enumerate(random_times(rng, 80, 8 * S, S // 2)):
                pnid = rng.randrange(3) if source == "TRG" else 0
                rows.append((vehicle, source, us, pnid, i * 2**19, rng.choice(["on", "off"])))
    df = frame(spark, rows, "vehicle_id string, source string, us bigint, ord1 bigint, ord2 bigint, status string")
    got = ignition_changes(df, hot_cells(df, p), p).selectExpr(
        "vehicle_id", "source", f"{micros('event_ts')} as us", "ord1", "ord2", "if(event = 'ignitionOn', 'on', 'off')"
    ).collect()
    assert sorted(map(tuple, got)) == sorted(brute.changes(rows))


@pytest.mark.parametrize("grain", [S, S // 4])
@pytest.mark.parametrize("p", CUTS)
def test_fusion(spark, p, grain):
    rng = random.Random(2)
    rows = []
    for v in range(12):
        pool = [("ignitionOff", "SYN")] * rng.choice([1, 12]) + [
            (e, s) for e in ("ignitionOn", "ignitionOff") for s in ("TLM", "TRG")
        ] * rng.choice([0, 1])
        for i, us in enumerate(random_times(rng, 60, rng.choice([4, 9, 14]) * S, grain)):
            event, source = rng.choice(pool)
            rows.append((f"v{v}", event, us, source, rng.randrange(2) if source == "TRG" else 0, i * 2**19))
    df = frame(spark, rows, "vehicle_id string, event string, us bigint, source string, ord1 bigint, ord2 bigint")
    got = fuse_all(df, hot_cells(df, p), p).selectExpr(
        "vehicle_id", "event", f"{micros('event_ts')} as us", "source", "ord1", "ord2"
    ).collect()
    assert sorted(map(tuple, got)) == sorted(brute.fused(rows))


@pytest.mark.parametrize("grain", [S, S // 10, 137_003])
@pytest.mark.parametrize("p", [
    Params(), Params(slice_sec=10, battery_window_sec=6), Params(slice_sec=1, battery_window_sec=2),
    Params(max_slice_rows=20), Params(slice_sec=130, max_slice_rows=3, broadcast_rows=0),
])
def test_nearest(spark, p, grain):
    rng = random.Random(3)
    readings, events = [], []
    for vehicle in "ab":
        for i, us in enumerate(random_times(rng, 150, 5 * S, grain)):
            source = rng.choice(["TLM", "TRG"])
            pnid = rng.randrange(4) if source == "TRG" else 0
            readings.append((vehicle, us, source, pnid, i, float(rng.randrange(100))))
        for us in random_times(rng, 60, 12 * S, grain):
            events.append((vehicle, us + rng.choice([0, 1, S // 2, -S // 3])))
    events.append(("none", BASE))
    line = frame(spark, readings, "vehicle_id string, us bigint, source string, ord1 bigint, ord2 bigint, battery_pct double", name="ts")
    probes = frame(spark, events, "vehicle_id string, us bigint")
    got = attach_battery(probes, line, p).selectExpr(
        "vehicle_id", f"{micros('event_ts')}", "battery_pct", f"{micros('battery_ts')}"
    ).collect()
    want = []
    for vehicle, us in events:
        mine = sorted(r[1:] for r in readings if r[0] == vehicle)
        hit = brute.nearest(us, mine, p.battery_window_sec) or (None, None)
        want.append((vehicle, us, *hit))
    key = lambda row: str(row)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("p", CUTS)
def test_sessions(spark, p):
    rng = random.Random(4)
    rows = []
    for v in range(6):
        for i, us in enumerate(random_times(rng, 60, 500 * S, S)):
            kind = rng.randrange(2)
            event = rng.choice(["ignitionOn", "ignitionOff"]) if kind == 0 else "Active"
            pct = rng.choice([None, rng.randrange(1000) / 8, rng.randrange(10000) / 100])
            prio = rng.randrange(3) if kind == 0 else 0
            pnid = rng.randrange(3) if kind == 1 or prio == 1 else 0
            rows.append((f"v{v}", us, kind, prio, pnid, i * 2**19, event, pct))
    df = frame(
        spark, rows,
        "vehicle_id string, us bigint, kind int, prio int, ord1 bigint, ord2 bigint, event string, battery_pct double",
    )
    hot = hot_cells(df, p)
    merged = merge_sessions(sessions_before_merge(charge_pairs(df, hot, p), p), hot, p)
    got = charging_events(merged, p).selectExpr(
        "vehicle_id", micros("start_ts"), micros("end_ts"), "delta_battery_pct",
        "start_battery_pct", "end_battery_pct", "ignition_state",
    ).collect()
    want = brute.sessions(rows)
    assert len(want) > 20
    assert sorted(map(tuple, got)) == want


def test_long_run_over_many_slices(spark):
    """Pulses every 7 s for hours: each slice is one unbroken run, so the chain decides all."""
    rows = [("v", "ignitionOff", BASE + i * 7 * S, "SYN", 0, i) for i in range(2000)]
    df = frame(spark, rows, "vehicle_id string, event string, us bigint, source string, ord1 bigint, ord2 bigint")
    got = fuse_all(df, None, Params(slice_sec=100)).selectExpr(f"{micros('event_ts')} as us").collect()
    assert sorted(r.us for r in got) == [r[2] for r in brute.fused(rows)]


def test_copies_at_one_instant(spark):
    """A large group of copies at one instant collapses; alternating ones are all kept."""
    p = Params(max_slice_rows=100)
    same = [("copy", "TLM", BASE, 0, i, "on") for i in range(3000)]
    flip = [("flip", "TLM", BASE, 0, i << 17, ["on", "off"][i % 2]) for i in range(3000)]
    df = frame(spark, same + flip, "vehicle_id string, source string, us bigint, ord1 bigint, ord2 bigint, status string")
    hot = hot_cells(df, p)
    assert {(r.vehicle_id, len(r.instants)) for r in hot.table.collect()} == {("copy", 1), ("flip", 1)}
    events = ignition_changes(df, hot, p)
    counts = {r.vehicle_id: r["count"] for r in events.groupBy("vehicle_id").count().collect()}
    assert counts == {"copy": 1, "flip": 3000}
    kept = fuse_all(events, hot, p).groupBy("vehicle_id").count().collect()
    assert {r.vehicle_id: r["count"] for r in kept} == {"copy": 1, "flip": 3000}


def test_no_pairs_are_formed_for_nearest(spark):
    line = frame(spark, [("a", BASE, "TLM", 0, 0, 1.0)], "vehicle_id string, us bigint, source string, ord1 bigint, ord2 bigint, battery_pct double", name="ts")
    plan = nearest_readings(frame(spark, [("a", BASE)], "vehicle_id string, us bigint"), line, Params())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text

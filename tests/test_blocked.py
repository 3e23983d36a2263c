"""Blocked scans, composed runs and the tree of times: equal to plain loops, and no group grows with a sequence."""

import random

import numpy as np
import pytest

from ampline.config import Params
from ampline.functions.scalars import micros, no_chunk
from ampline.operators import battery, fusion, scan, slices
from ampline.operators.charging import merge_sessions
from tests import brute
from tests.test_sequences import BASE, S, frame, fuse_all, hot_cells


@pytest.fixture
def tables(monkeypatch):
    """Tables written by the ordered steps, as (label, table)."""
    seen = []

    def watched(df, label, real=scan.stage):
        seen.append((label, real(df, label)))
        return seen[-1][1]

    for module in (scan, slices, battery, fusion):
        monkeypatch.setattr(module, "stage", watched)
    return seen


def largest(table, *keys):
    return table.groupBy(*keys).count().agg({"count": "max"}).first()[0]


def of(tables, label):
    return [table for name, table in tables if name == label]


@pytest.mark.parametrize("block_rows", [None, 7, 40, 10_000])
def test_scan_equals_a_loop(spark, tables, block_rows):
    rng = random.Random(block_rows or 1)
    rows = [
        (key, place, rng.choice([None, rng.randrange(99)]), rng.choice([None, None, str(place)]))
        for key, n in (("hot", 400), ("small", 3), ("one", 1)) for place in rng.sample(range(2000), n)
    ]
    table = spark.createDataFrame(rows, "key string, place int, number int, word string")
    got = scan.scanned(
        table, ("key",), "place", {"last_number": "number", "last_word": "word"}, {"next_number": "number"}, block_rows
    )
    want = []
    for key, place, number, word in rows:
        line = sorted(r for r in rows if r[0] == key)
        earlier, later = [r for r in line if r[1] < place], [r for r in line if r[1] > place]
        pick = lambda values: next((v for v in values if v is not None), None)
        want.append((
            key, place, number, word, pick(r[2] for r in earlier[::-1]), pick(r[3] for r in earlier[::-1]), pick(r[2] for r in later),
        ))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    blocks = of(tables, "scan-blocks")
    assert bool(blocks) == (block_rows in (7, 40))
    assert all(largest(b, "key", "block") <= 2 * block_rows for b in blocks)


def test_scan_of_nothing(spark):
    empty = spark.createDataFrame([], "key string, place int, x int")
    assert scan.scanned(empty, ("key",), "place", {"y": "x"}, block_rows=5).collect() == []


def test_steps_compose():
    """Composed functions give what a walk over all times gives, from every time before them."""
    rng = np.random.default_rng(4)
    for _ in range(200):
        gap = int(rng.integers(2, 30))
        us = np.unique(rng.integers(0, 300, rng.integers(3, 120)))
        cuts = np.unique(rng.integers(1, len(us), 5)) if len(us) > 1 else []
        pieces = [fusion.steps_of(x, gap) for x in np.split(us, cuts)]
        whole = fusion.composed(pieces, gap)
        for before in range(int(us[0]) - 2 * gap, int(us[0]) + 1):
            last = before
            for x in us:
                last = int(x) if x - last >= gap else last
            assert int(whole(np.array([before]), gap)[0]) == last
            assert fusion.walked([*pieces, None], before, gap)[-1] == last
        assert len(whole.entry) <= np.searchsorted(us, us[0] + gap) + 1


def test_a_run_of_many_slices_meets_in_small_groups(spark, tables, monkeypatch):
    """100,000 slices of one run: no group has more than 64 of them, no window more than a block."""
    sizes = []

    def watched(links, block, real=fusion._in_blocks):
        out = real(links, block)
        sizes.append(out.selectExpr("max(size(links))"))
        return out

    monkeypatch.setattr(fusion, "_in_blocks", watched)
    n, p = 100_000, Params(slice_sec=7, scan_block_rows=5_000)
    rows = spark.range(n).selectExpr(
        "'v' as vehicle_id", "'ignitionOff' as event", f"{BASE} + id * {7 * S} + if(id % 5 = 0, 1, 0) as us",
        "'SYN' as source", "0L as ord1", "id as ord2",
    )
    df = rows.selectExpr("*", "cast(timestamp_micros(us) as timestamp_ntz) as event_ts").drop("us")
    got = sorted(r.us for r in fuse_all(df, None, p).selectExpr(f"{micros('event_ts')} as us").collect())
    last, want = None, []
    for i in range(n):
        us = BASE + i * 7 * S + (i % 5 == 0)
        if last is None or us - last >= 10 * S:
            last = us
            want.append(us)
    assert got == want
    assert len(sizes) >= 5 and max(s.first()[0] for s in sizes) <= p.chain_slices
    assert max(largest(b, "vehicle_id", "block") for b in of(tables, "scan-blocks")) <= 2 * p.scan_block_rows


@pytest.mark.parametrize("p", [Params(slice_sec=3, chain_slices=2, scan_block_rows=6), Params(slice_sec=600, max_slice_rows=2, chain_slices=3, scan_block_rows=4)])
def test_fusion_with_small_blocks(spark, p):
    rng = random.Random(12)
    rows, at = [], {}
    for i in range(700):
        vehicle = f"v{i % 3}"
        at[vehicle] = at.get(vehicle, BASE) + rng.choice([S, 2 * S, 7 * S, 3 * S // 2, 9 * S] + [14 * S] * (i % 3))
        rows.append((vehicle, "ignitionOff" if rng.random() < 0.97 else "ignitionOn", at[vehicle], "TLM", 0, i * 2**19))
    df = frame(spark, rows, "vehicle_id string, event string, us bigint, source string, ord1 bigint, ord2 bigint")
    got = fuse_all(df, hot_cells(df, p), p).selectExpr("vehicle_id", "event", f"{micros('event_ts')} as us", "source", "ord1", "ord2")
    assert sorted(map(tuple, got.collect())) == sorted(brute.fused(rows))


def test_only_crowded_pieces_are_cut(spark):
    """One crowded second adds at most 1,000 slices; the rest of its hour is cut into minutes and seconds."""
    p = Params(max_slice_rows=200)
    crowded = [("a", BASE + 1800 * S + i * 97) for i in range(9000)]
    sparse = [(v, BASE + i * 30 * S) for v in "ab" for i in range(120)]
    df = frame(spark, crowded + sparse, "vehicle_id string, us bigint").selectExpr("*", f"{micros('event_ts')} as us")
    hot = slices.find_hot_cells(df, p)
    (row,) = hot.table.collect()
    assert (row.vehicle_id, row.minutes, row.seconds) == ("a", [BASE + 1800 * S], [BASE + 1800 * S])
    assert row.millis == [] and row.instants == []
    placed = slices.with_slice(df, no_chunk(), hot, p)
    assert largest(placed, "vehicle_id", "slice") <= p.max_slice_rows
    count = lambda v: placed.where(f"vehicle_id = '{v}'").select("slice").distinct().count()
    assert count("b") == 1 and 874 <= count("a") <= 1000 + 60 + 60
    order = placed.where("vehicle_id = 'a'").orderBy("us").select("slice").collect()
    assert order == sorted(order)


def test_a_stuck_clock_is_cut_by_input_order(spark):
    p = Params(max_slice_rows=100)
    rows = [("a", BASE + (i % 50) * S, i) for i in range(400)] + [("a", BASE + 25 * S, 1000 + i) for i in range(3000)]
    df = frame(spark, rows, "vehicle_id string, us bigint, ord bigint").selectExpr("*", f"{micros('event_ts')} as us")
    hot = slices.find_hot_cells(df, p)
    (row,) = hot.table.collect()
    assert row.instants == row.millis == row.seconds == [BASE + 25 * S]
    placed = slices.with_slice(df, "named_struct('prio', 0, 'file', '', 'block', ord div 64)", hot, p)
    assert largest(placed, "vehicle_id", "slice") <= p.max_slice_rows


def test_nearest_reading_in_a_crowded_minute(spark, tables):
    """Distinct instants crowd one minute: every slice of the look-up stays small, and probes are not copied."""
    rng = random.Random(6)
    p = Params(max_slice_rows=300, scan_block_rows=50)
    times = sorted(rng.sample(range(60 * S), 6000))
    readings = [("a", BASE + t, "TLM", 0, i, float(i % 100)) for i, t in enumerate(times)]
    readings += [("a", BASE + 200 * S + i * S // 3, "TLM", 0, 9000 + i, 7.0) for i in range(20)]
    events = [("a", BASE + rng.randrange(-400 * S, 700 * S)) for _ in range(150)] + [("a", BASE + rng.randrange(60 * S)) for _ in range(150)]
    line = frame(spark, readings, "vehicle_id string, us bigint, source string, ord1 bigint, ord2 bigint, battery_pct double", name="ts")
    probes = frame(spark, events, "vehicle_id string, us bigint")
    got = battery.attach_battery(probes, line, p).selectExpr(micros("event_ts"), "battery_pct", micros("battery_ts")).collect()
    mine = [r[1:] for r in readings]
    want = [(us, *(brute.nearest(us, mine, p.battery_window_sec) or (None, None))) for _, us in events]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    first, second = of(tables, "look-up")
    assert first.count() == len(readings) + len(set(events)) and second.count() <= first.count()
    assert max(largest(t, "vehicle_id", "slice") for t in (first, second)) <= p.max_slice_rows


def test_joined_sessions_over_many_slices(spark, tables):
    """A chain of sessions that joins thousands of slices, and gaps that end it at any slice."""
    rng = random.Random(2)
    rows, at = [], BASE
    for i in range(3000):
        end = at + rng.randrange(1, 40) * S
        rows.append(("v", at, end, 1.0, float(i % 50), float(i % 50) + 1, "ignitionOff"))
        at = end + (rng.choice([300, 301, 400]) if rng.random() < 0.01 else rng.randrange(0, 299)) * S
    schema = "vehicle_id string, us bigint, end_us bigint, delta_battery_pct double, start_battery_pct double, end_battery_pct double, ignition_state string"
    raw = spark.createDataFrame(rows, schema).selectExpr(
        "vehicle_id", "cast(timestamp_micros(us) as timestamp_ntz) as start_ts", "cast(timestamp_micros(end_us) as timestamp_ntz) as end_ts",
        "delta_battery_pct", "start_battery_pct", "end_battery_pct", "1D as duration_sec", "ignition_state",
    )
    p = Params(slice_sec=60, scan_block_rows=100)
    got = merge_sessions(raw, None, p).selectExpr(micros("start_ts"), micros("end_ts")).collect()
    want = []
    for _, us, end, *_ in rows:
        if want and us - want[-1][1] <= 300 * S:
            want[-1][1] = end
        else:
            want.append([us, end])
    assert sorted(map(list, got)) == want and len(want) > 10
    assert max(largest(b, "vehicle_id", "block") for b in of(tables, "scan-blocks")) <= 2 * p.scan_block_rows

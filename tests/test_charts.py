"""Chart tables on small and odd inputs."""

import datetime as dt
import math
import statistics

import pytest

from ampline.config import Params
from ampline.operators import battery, charts
from ampline.operators.ranking import numbered

P = Params()
SCHEMA = (
    "vehicle_id string, start_ts timestamp_ntz, end_ts timestamp_ntz, delta_battery_pct double, "
    "start_battery_pct double, end_battery_pct double, duration_sec double, ignition_state string"
)
NOON = dt.datetime(2024, 1, 1, 12)


def sessions(spark, spec):
    """spec: (vehicle, start hour offset, minutes, delta)"""
    rows = [
        (v, NOON + dt.timedelta(hours=h), NOON + dt.timedelta(hours=h, minutes=m), d, 10.0, 10.0 + d, m * 60.0, "unknown")
        for v, h, m, d in spec
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_empty_input_gives_empty_tables(spark):
    none = sessions(spark, [])
    for table in [
        charts.duration_hist(none, P), charts.duration_kde(none, P), charts.gain_box(none), charts.gain_outliers(none),
        charts.sessions_per_vehicle(none), charts.hour_heatmap(none), charts.battery_points(none), charts.battery_line(none),
    ]:
        assert table.collect() == []


def test_one_session(spark):
    one = sessions(spark, [("a", 0, 7, 3.0)])
    bins = charts.duration_hist(one, P).orderBy("bin").collect()
    assert len(bins) == 30 and sum(b.n for b in bins) == 1
    assert (bins[0].bin_start, round(bins[-1].bin_end, 9)) == (6.5, 7.5)
    assert bins[15].n == 1
    assert charts.duration_kde(one, P).collect() == []
    assert tuple(charts.gain_box(one).first()) == (3.0, 3.0, 3.0, 3.0, 3.0, 1)


def test_histogram_edges(spark):
    bins = charts.duration_hist(sessions(spark, [("a", h, m, 3.0) for h, m in enumerate([0, 1, 30, 30, 29])]), P)
    counts = {b.bin: b.n for b in bins.collect() if b.n}
    assert counts == {0: 1, 1: 1, 29: 3}  # the right edge belongs to the last bin


def test_density(spark):
    minutes = [3, 5, 5, 9, 20]
    got = charts.duration_kde(sessions(spark, [("a", i, m, 3.0) for i, m in enumerate(minutes)]), P).orderBy("i").collect()
    width = statistics.stdev(minutes) * len(minutes) ** -0.2
    assert len(got) == 200
    for r in got[::37]:
        x = 3 + r.i * 17 / 199
        want = sum(math.exp(-0.5 * ((x - m) / width) ** 2) for m in minutes) / (width * math.sqrt(2 * math.pi)) * 17 / 30
        assert r.x == pytest.approx(x) and r.density == pytest.approx(want)


def test_box_and_outliers(spark):
    data = sessions(spark, [("a", i, 5, d) for i, d in enumerate([2.0, 3.0, 4.0, 5.0, 40.0, -30.0])])
    box = charts.gain_box(data).first()
    assert (box.q1, box.median, box.q3) == (2.25, 3.5, 4.75)
    assert (box.whisker_low, box.whisker_high, box.n) == (2.0, 5.0, 6)
    assert {r.delta_battery_pct for r in charts.gain_outliers(data).collect()} == {40.0, -30.0}


def test_counts_add_up(spark):
    data = sessions(spark, [("a", 0, 5, 2.0), ("a", 24, 5, 2.0), ("b", 11, 5, 2.0)])
    rows = {r.vehicle_id: r.asDict() for r in charts.hour_heatmap(data).collect()}
    assert (rows["a"]["h12"], rows["b"]["h23"]) == (2, 1)
    assert sum(v for r in rows.values() for k, v in r.items() if k.startswith("h")) == 3
    assert [tuple(r) for r in charts.sessions_per_vehicle(data).collect()] == [("a", 2), ("b", 1)]


def test_line_averages_equal_times(spark):
    data = sessions(spark, [("a", 0, 60, 2.0), ("a", 1, 60, 4.0)])
    assert [tuple(r) for r in charts.battery_line(data).orderBy("ts").collect()] == [
        ("a", NOON, 10.0), ("a", NOON + dt.timedelta(hours=1), 11.0), ("a", NOON + dt.timedelta(hours=2), 14.0),
    ]


def test_numbering_is_dense_over_many_ranges(spark):
    names = spark.range(5000).selectExpr("concat('v', id * 7919 % 5000) as name").repartition(9)
    got = [(r.n, r.name) for r in numbered(names, ["name"], "n").orderBy("n").collect()]
    assert got == list(enumerate(sorted(f"v{i}" for i in range(5000))))


def test_association_rate_of_nothing(spark):
    none = spark.createDataFrame([], "battery_pct double")
    assert tuple(battery.association_rate(none).first()) == (0, 0, 0.0)

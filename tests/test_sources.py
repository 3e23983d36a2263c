"""Text-level reading: index column, zones, quotes, missing texts, several files, write and read back."""

import datetime as dt
import json

import pytest

from ampline.functions.scalars import parse_local, parse_to_ist, python_quote, to_number, with_id_list
from ampline.operators import cleaning, mapping, quality
from ampline.plans.pipeline import read_feeds, run
from ampline.sources import readers

T = dt.datetime


def one(spark, expr_of, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").selectExpr("i", f"{expr_of('v')} as x").orderBy("i")
    return [r.x for r in df.collect()]


def test_local_times(spark):
    got = one(spark, parse_local, [
        "2024-01-01 10:00:00", "2024-01-01T10:00:00.25", "2024-01-01", "  2024-01-01 10:00 ",
        "2024-01-01 10:00:00+05:30", "2024-01-01T10:00:00Z", "10:00:00", "junk", None, "2024-13-01",
    ])
    ten = T(2024, 1, 1, 10)
    assert got == [ten, ten.replace(microsecond=250000), T(2024, 1, 1), ten, None, None, None, None, None, None]


def test_times_shifted_to_ist(spark):
    got = one(spark, parse_to_ist, [
        "2024-01-01 10:00:00 IST+0530", "2024-01-01 10:00:00IST+0530", "2024-01-01 10:00:00", "2024-01-01T10:00:00.5Z",
        "2024-01-01 10:00:00+0530", "2024-01-01", "junk", None, "2024-01-01 10:00:00.123456 IST+0530",
    ])
    ten, shifted = T(2024, 1, 1, 10), T(2024, 1, 1, 15, 30)
    assert got == [
        ten, ten, shifted, shifted.replace(microsecond=500000), ten, T(2024, 1, 1, 5, 30), None, None,
        ten.replace(microsecond=123456),
    ]


def test_numbers(spark):
    got = one(spark, to_number, ["1", " 2.5 ", "-3e2", ".5", "12d", "n/a", "NaN", "inf", "", None, "0x1F"])
    assert got == [1.0, 2.5, -300.0, 0.5, None, None, None, float("inf"), None, None, None]


@pytest.mark.parametrize("text,ids", [
    ("[1, 2]", [1, 2]), ('["3", "4"]', [3, 4]), ("['3','4']", [3, 4]), ("(5, 6)", [5, 6]), ("{7,8}", [7, 8]),
    ("9, 10", [9, 10]), ("[1,]", [1]), ("(1,)", [1]), ("[]", []), ("()", []), ("[1.9, -2]", [1, -2]),
    ("[1, x]", None), ("[1, null]", None), ("12", None), ("(5)", None), ("broken[", None), ("[1, , 2]", None),
    ('["7.9"]', None), (None, None), ("", None), ("[9007199254740993]", [9007199254740993]),
])
def test_id_lists(spark, text, ids):
    df = spark.createDataFrame([(text,)], "v string")
    assert with_id_list(df, "v", "x").first().x == ids


def test_quotes(spark):
    assert one(spark, python_quote, ["a", "it's", "it's \"x\"", "b\\c", None])[:4] == [
        "'a'", '"it\'s"', "'it\\'s \"x\"'", "'b\\\\c'",
    ]


@pytest.fixture
def feed_dir(tmp_path):
    (tmp_path / "tlm.csv").write_text(
        ",ID,VEHICLE_ID,TIMESTAMP,SPEED,IGNITION_STATUS,EV_BATTERY_LEVEL,ODOMETER\n"
        "0,a,A,2024-01-01 00:00:00,-4,\tOn ,50,NA\n"
        "1,b,A,2024-01-01 00:01:00,,Unknown,101,NA\n"
        "2,c,A,2024-01-01 00:02:00,,on,,NA\n"
        "3,c,A,2024-01-01 00:03:00,,off,-3,NA\n"
        "4,d,A,not a time,,off,10,NA\n"
        "5,e,A,2024-01-01 00:05:00,1,off,60.25,7\n"
        "6,f,,2024-01-01 00:05:00,1,off,60,7\n"
        "7,g,A,2024-01-01 00:10:00,,on,70.5,8\n"
    )
    (tmp_path / "trg.csv").write_text(
        "CTS,PNID,NAME,VAL\n"
        "2024-01-01 00:00:03 IST+0530,3,IGN_CYL,ON\n"
        "2024-01-01 00:00:03 IST+0530,3,IGN_CYL,ON\n"
        "2023-12-31 18:36:40,4,EV_CHARGE_STATE,Aborted\n"
        "2024-01-01 00:06:45 IST+0530,4,EV_CHARGE_STATE,Completed\n"
        "2024-01-01 00:06:40 IST+0530,3,CHARGE_STATE,66\n"
        "2024-01-01 00:00:09 IST+0530,99,IGN_CYL,OFF\n"
        "2024-01-01 00:00:09 IST+0530,3,IGN_CYL,CRANK\n"
        "2024-01-01 00:00:09 IST+0530,3,HORN,1\n"
        "2024-01-01 00:00:09 IST+0530,3,CHARGE_STATE,low\n"
        "2024-01-01 00:00:09 IST+0530,3,EV_CHARGE_STATE,Abort\n"
        "soon,3,IGN_CYL,ON\n"
    )
    (tmp_path / "map.csv").write_text(
        'Unnamed: 0,ID,IDS\n0,A,[]\n1,A,"[""3"", ""4""]"\n2,B,"[4, 5]"\n3,C,\n4,D,oops[\n5,A,"[""3"", ""4""]"\n'
    )
    (tmp_path / "syn.json").write_text(json.dumps([
        {"vehicleId": "A", "timestamp": "2023-12-31T18:35:08Z", "type": "ignitionOff"},
        {"vehicleId": "Z", "timestamp": "2024-01-01T00:00:00+05:30", "type": "ignitionOff"},
        {"vehicleId": "Z", "timestamp": "never", "type": "ignitionOff"},
    ]))
    return tmp_path


def feeds_of(spark, folder):
    names = ["tlm.csv", "trg.csv", "map.csv", "syn.json"]
    return read_feeds(spark, *[str(folder / n) for n in names])


def test_cleaned_telemetry(spark, feed_dir):
    rows = cleaning.clean_tlm(feeds_of(spark, feed_dir).tlm).orderBy("row_ord").collect()
    got = [(r.ID, r.SPEED, r.IGNITION_STATUS, r.EV_BATTERY_LEVEL, r.ODOMETER) for r in rows]
    assert got == [
        ("a", 0.0, "on", 50.0, None), ("b", None, None, 100.0, None), ("c", None, "on", None, None),
        ("e", 1.0, "off", 60.25, 7.0), ("f", 1.0, "off", 60.0, 7.0), ("g", None, "on", 70.5, 8.0),
    ]


def test_map_last_entry_wins(spark, feed_dir):
    parsed = mapping.parse_map(feeds_of(spark, feed_dir).map)
    assert {(r.pnid, r.vehicle_id) for r in mapping.pnid_map(parsed).collect()} == {(3, "A"), (4, "A"), (5, "B")}
    rules = [(r.rule, r.item) for r in quality.map_findings(parsed).orderBy("stage", "k1").collect()]
    assert rules == [("DQ-14", "C"), ("DQ-15", "D"), ("DQ-16", "4")]


def test_whole_run(spark, feed_dir, tmp_path):
    out = str(tmp_path / "out")
    run(feeds_of(spark, feed_dir), out)
    back = readers.read_results(spark, out)
    ign = [tuple(r) for r in back["IgnitionEvents"].orderBy("vehicle_id", "event_ts").collect()]
    assert ign == [
        ("A", "ignitionOn", T(2024, 1, 1, 0, 0, 0)),
        ("A", "ignitionOff", T(2024, 1, 1, 0, 5, 0)),
        ("A", "ignitionOn", T(2024, 1, 1, 0, 10, 0)),
        ("Z", "ignitionOff", T(2024, 1, 1)),
    ]
    status = [tuple(r) for r in back["ChargingStatusEvents"].orderBy("event_ts").collect()]
    assert status == [("A", "Abort", T(2024, 1, 1, 0, 6, 40)), ("A", "Complete", T(2024, 1, 1, 0, 6, 45))]
    # Off 00:05:00 (60.25) -> Abort 00:06:40 (66) -> Complete 00:06:45 (66) -> On 00:10 (70.5).
    # On 00:00:00 (50) -> Off 00:05:00 (60.25) rises enough while on; all join into one session.
    sessions = [tuple(r) for r in back["ChargingEvents"].collect()]
    assert sessions == [("A", T(2024, 1, 1), T(2024, 1, 1, 0, 10), 20.5, 50.0, 70.5, 600.0, "ignitionOn")]
    report = "\n".join(r.value for r in spark.read.text(f"{out}/data_quality_report").collect())
    lines = [x for x in report.split("\n") if x]
    assert lines[:2] == ["DATA QUALITY REPORT", "=" * 60]
    assert lines[2:] == [
        "1. TLM: 1 rows with unparseable timestamps — dropped.",
        "2. TLM: 1 rows have IGNITION_STATUS='unknown' — treated as missing.",
        "3. TLM: 1 battery readings > 100 % — capped at 100.",
        "4. TLM: 1 negative battery readings — set to NaN.",
        "5. TLM: 1 negative speed readings — set to 0.",
        "6. TLM: 1 duplicate row IDs — deduplicated.",
        "7. TLM: 1 rows without a vehicle id — dropped.",
        "8. TRG: 1 rows with unparseable timestamps — dropped.",
        "9. TRG: 1 rows with unexpected NAME values (1 different) — dropped.",
        "    'HORN' (1 rows)",
        "10. TRG: 1 IGN_CYL rows with unexpected VAL (1 different) — dropped.",
        "    'CRANK' (1 rows)",
        "11. TRG: 1 CHARGE_STATE rows with non-numeric VAL — dropped.",
        "12. TRG: 1 EV_CHARGE_STATE rows with unexpected VAL (1 different) — dropped.",
        "    'Abort' (1 rows)",
        "13. TRG: 1 exact duplicate rows — deduplicated.",
        "14. MAP: Vehicle C has no PNIDs — will get events only from TLM/SYN.",
        "15. MAP: Could not parse PNIDs for vehicle D: 'oops['",
        "16. MAP: PNID 4 maps to multiple vehicles: B and A. Using latest.",
        "17. SYN: 1 rows with unparseable timestamps — dropped.",
        "18. TRG→IGN: 1 IGN_CYL rows with unmapped PNIDs (1 different) — dropped.",
        "    99 (1 rows)",
        "19. Ignition fusion: 2 near-duplicate events removed (same vehicle + event within 10 s).",
    ]


def test_empty_feeds_give_empty_tables(spark, tmp_path):
    (tmp_path / "tlm.csv").write_text("ID,VEHICLE_ID,TIMESTAMP,SPEED,IGNITION_STATUS,EV_BATTERY_LEVEL,ODOMETER\n")
    (tmp_path / "trg.csv").write_text("CTS,PNID,NAME,VAL\n")
    (tmp_path / "map.csv").write_text("ID,IDS\n")
    (tmp_path / "syn.json").write_text("[]")
    out = str(tmp_path / "out")
    run(feeds_of(spark, tmp_path), out)
    for name, table in readers.read_results(spark, out).items():
        assert table.count() == 0, name
    header = spark.read.text(f"{out}/ChargingEvents").collect()
    assert header[0].value.startswith("vehicle_id,start_ts,end_ts,delta_battery_pct")


def test_row_order_over_several_files(spark, tmp_path):
    folder = tmp_path / "many files"
    folder.mkdir()
    for i in range(7):
        body = "".join(f"{i * 100 + j},1\n" for j in range(30))
        (folder / f"part {i}.csv").write_text("ID,IDS\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")  # several blocks per file
    try:
        rows = readers.read_map(spark, str(folder)).orderBy("row_ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [int(r.ID) for r in rows] == [i * 100 + j for i in range(7) for j in range(30)]


def test_run_on_several_files(spark, feed_dir, tmp_path):
    """The same telemetry cut into three files gives the same cleaned rows in the same order."""
    lines = (feed_dir / "tlm.csv").read_text().splitlines()
    parts = tmp_path / "parts"
    parts.mkdir()
    for i, chunk in enumerate([lines[1:4], lines[4:5], lines[5:]]):
        (parts / f"{i}.csv").write_text("\n".join([lines[0], *chunk]) + "\n")
    whole = feeds_of(spark, feed_dir)
    cut = whole._replace(tlm=readers.read_tlm(spark, str(parts)))
    out = str(tmp_path / "out")
    run(cut, out)
    assert readers.read_results(spark, out)["ChargingEvents"].count() == 1
    same = lambda feeds: [r[1:] for r in cleaning.clean_tlm(feeds.tlm).orderBy("row_ord").collect()]
    assert same(cut) == same(whole)


def test_file_order_has_one_kind(spark, feed_dir, tmp_path):
    """One file or many, places have one kind, so feeds of either layout go into one sequence."""
    from ampline.config import Params
    from ampline.operators import slices
    from ampline.operators.ignition import ignition_changes
    from ampline.plans.pipeline import Flow

    parts = tmp_path / "tlm-parts"
    parts.mkdir()
    head = "ID,VEHICLE_ID,TIMESTAMP,SPEED,IGNITION_STATUS,EV_BATTERY_LEVEL,ODOMETER\n"
    for i in range(6):  # a stuck clock: all at one instant, in files of 20 rows
        rows = "".join(f"{i}-{j},A,2024-01-01 00:00:00,1,{'on' if (i + j) % 2 else 'off'},50,1\n" for j in range(20))
        (parts / f"{i}.csv").write_text(head + rows)
    one = feeds_of(spark, feed_dir)
    many = one._replace(tlm=readers.read_tlm(spark, str(parts)))
    assert many.tlm.schema["row_ord"].dataType == one.tlm.schema["row_ord"].dataType == one.syn.schema["row_ord"].dataType
    p = Params(max_slice_rows=30)
    flow = Flow(many, p)
    rows = flow.feeds.tlm.selectExpr(
        "VEHICLE_ID as vehicle_id", "IGNITION_STATUS as status", "TIMESTAMP as event_ts", "'TLM' as source", "0L as ord1", "row_ord as ord2"
    )
    assert flow.hot_tlm is not None
    placed = slices.with_slice(rows.selectExpr("*", f"{slices.micros('event_ts')} as us"), slices_chunk(rows), flow.hot_tlm, p)
    assert max(r["count"] for r in placed.groupBy("slice").count().collect()) == 20
    assert ignition_changes(rows, flow.hot_tlm, p).count() == ignition_changes(rows, None, Params()).count()


def slices_chunk(rows):
    from ampline.functions.scalars import file_chunk

    return file_chunk(rows, "ord2")


@pytest.mark.parametrize("feed", ["syn", "trg", "plug"])
def test_hours_crowded_in_any_feed_are_cut(spark, feed):
    """The largest group of an ordered step stays small wherever the rows come from."""
    from ampline.config import Params
    from ampline.operators import slices

    n = 600
    rows = spark.range(n).selectExpr("'A' as vehicle_id", "timestamp_micros(1704067200000000 + id * 1000) as t")
    rows = rows.selectExpr("vehicle_id", "cast(t as timestamp_ntz) as event_ts")
    p = Params(max_slice_rows=100)
    hot = slices.find_hot_cells(rows, p)
    placed = slices.with_slice(rows.selectExpr("*", f"{slices.micros('event_ts')} as us"), slices.no_chunk(), hot, p)
    assert max(r["count"] for r in placed.groupBy("slice").count().collect()) <= 100
    flow = crowded_flow(spark, feed, n, p)
    assert flow.hot is not None and flow.hot.table.first().seconds  # cut into milliseconds


def crowded_flow(spark, feed, n, p):
    """Feeds with ``n`` rows of one vehicle within a second, in one of them."""
    from ampline.plans.pipeline import Flow
    from ampline.sources.readers import Feeds

    ids = spark.range(n).selectExpr("id", "cast(timestamp_micros(1704067200000000 + id * 1000) as timestamp_ntz) as t")
    none = lambda df, on: df if feed in on else df.where("false")
    tlm = ids.where("false").selectExpr(
        "id as row_ord", "cast(id as string) as ID", "'A' as VEHICLE_ID", "t as TIMESTAMP", "1D as SPEED",
        "'on' as IGNITION_STATUS", "50D as EV_BATTERY_LEVEL", "1D as ODOMETER",
    )
    name, value = ("'EV_CHARGE_STATE'", "'Aborted'") if feed == "plug" else ("'IGN_CYL'", "if(id % 2 = 0, 'ON', 'OFF')")
    trg = none(ids, ("trg", "plug")).selectExpr("id as row_ord", "t as CTS", "1L as PNID", f"{name} as NAME", f"{value} as VAL")
    maps = spark.createDataFrame([(0, "A", "[1]")], "row_ord bigint, ID string, IDS string")
    syn = none(ids, ("syn",)).selectExpr("id as row_ord", "'A' as vehicleId", "t as timestamp", "'ignitionOff' as type")
    return Flow(Feeds(tlm, trg, maps, syn), p)


def test_times_in_named_formats(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "ID,VEHICLE_ID,TIMESTAMP,SPEED,IGNITION_STATUS,EV_BATTERY_LEVEL,ODOMETER\n"
        "a,A,2024/01/02 03:04:05,1,\u00a0on ,50,1\nb,A,02-01-2024 03:04,1,on,50,1\nc,A,20240102,1,on,50,1\nd,A,2024-01-02 03:04:05,1,on,50,1\n"
    )
    formats = ("yyyy/MM/dd HH:mm:ss", "dd-MM-yyyy HH:mm", "yyyyMMdd")
    rows = readers.read_tlm(spark, str(tmp_path / "t.csv"), formats).orderBy("ID").collect()
    assert [r.TIMESTAMP for r in rows] == [T(2024, 1, 2, 3, 4, 5), T(2024, 1, 2, 3, 4), T(2024, 1, 2), T(2024, 1, 2, 3, 4, 5)]
    assert [r.TIMESTAMP is None for r in readers.read_tlm(spark, str(tmp_path / "t.csv"), ()).orderBy("ID").collect()] == [True, True, True, False]
    clean = cleaning.clean_tlm(readers.read_tlm(spark, str(tmp_path / "t.csv"), formats)).where("ID = 'a'").first()
    assert clean.IGNITION_STATUS == "on"  # a no-break space is stripped as well
    (tmp_path / "s.json").write_text('{"vehicleId": "A", "timestamp": "2024/01/01 18:30:00", "type": "x"}\n{"vehicleId": "B"}\n')
    syn = readers.read_syn(spark, str(tmp_path / "s.json"), ("yyyy/MM/dd HH:mm:ss",), lines=True).orderBy("vehicleId").collect()
    assert [(r.vehicleId, r.timestamp) for r in syn] == [("A", T(2024, 1, 2)), ("B", None)]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_odd_texts_survive_the_sink(spark, tmp_path, fmt):
    from ampline.config import Params
    from ampline.sinks import writers

    odd = [" a ", 'he said "x"', "a,b", "two\nlines", "\\", "é", '"']
    rows = spark.createDataFrame([(v, "e", T(2024, 1, 1, 0, 0, 0, 5)) for v in odd], readers.EVENT_OUTPUT)
    writers.write_table(rows, str(tmp_path / "IgnitionEvents"), fmt)
    back = readers.read_results(spark, str(tmp_path), fmt)
    assert sorted(map(tuple, back["IgnitionEvents"].collect())) == sorted(map(tuple, rows.collect()))
    writers.write_chart_tables(back, str(tmp_path / "charts"), Params(), fmt)
    assert (tmp_path / "charts" / "ignition_timeline").exists()


def test_missing_result_tables_are_left_out(spark, tmp_path):
    from ampline.sinks import writers

    writers.write_table(spark.createDataFrame([], readers.SESSION_OUTPUT), str(tmp_path / "ChargingEvents"))
    assert list(readers.read_results(spark, str(tmp_path))) == ["ChargingEvents"]

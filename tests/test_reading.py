"""Forms of time, broken records, lost numbers, and what is read and left behind by a run."""

import datetime as dt
import json
import os
import random

import numpy as np
import pytest

from ampline.config import Params
from ampline.operators import quality
from ampline.operators.charts import outliers
from ampline.operators.ranking import quantiles
from ampline.plans.pipeline import Flow, read_feeds, run
from ampline.sources import readers
from ampline.sources.derived import DerivedFeeds
from ampline.sources.formats import FORMS, infer_formats
from ampline.staging import Staging, measured, new_path, stage
from tests.compare import DATA

T = dt.datetime
HEADER = "ID,VEHICLE_ID,TIMESTAMP,SPEED,IGNITION_STATUS,EV_BATTERY_LEVEL,ODOMETER\n"


def inferred(spark, values):
    return infer_formats(spark.createDataFrame([(v,) for v in values], "t string").coalesce(1), "t")


def test_one_form_is_found_from_all_values(spark):
    days = [f"{d:02d}/03/2024 10:{d:02d}" for d in range(1, 29)]
    got = inferred(spark, [None, "", *days, "junk"])
    assert got.formats == ("d/M/yyyy[ H:mm[:ss[.SSSSSS]]]",) and not got.ambiguous and got.n_values == 28
    assert inferred(spark, ["03/28/2024", "03/01/2024"]).formats == ("M/d/yyyy[ H:mm[:ss[.SSSSSS]]]",)
    assert inferred(spark, ["2 Mar 2024 1:02:03 PM"]).formats == ("d MMM yyyy h:mm[:ss[.SSSSSS]] a",)
    assert inferred(spark, ["20240301"]).formats == ("yyyyMMdd[ H:mm[:ss[.SSSSSS]]]",)
    assert inferred(spark, ["2024/03/28T10:00:00"]).formats == ("yyyy/M/d'T'H:mm[:ss[.SSSSSS]]",)


def test_swapped_days_and_mixed_forms(spark):
    both = inferred(spark, ["01/02/2024", "03/04/2024 10:00"])
    assert both.ambiguous and both.formats[0].startswith("M/d/yyyy") and both.n_values == 2
    mixed = inferred(spark, ["28/02/2024", "27/02/2024", "2024.02.28"])
    assert mixed.mixed and mixed.formats[0].startswith("d/M/yyyy") and any(f.startswith("yyyy.M.d") for f in mixed.formats)


def test_iso_and_empty_columns_need_no_form(spark):
    for values in ([], [None], ["2024-03-01 10:00", "01/02/2024"], ["junk", "more"], ["2024-03-01"]):
        assert inferred(spark, values).formats == ()
    assert len(FORMS) < 63  # a bit each


@pytest.mark.parametrize("form,written", [
    ("%d/%m/%Y %H:%M:%S", None), ("%m-%d-%Y %H:%M", None), ("%d.%m.%Y %H:%M:%S.%f", None), ("%d %b %Y %I:%M:%S %p", None),
    ("%Y/%m/%d %H:%M:%S", ("yyyy/MM/dd HH:mm:ss",)),
])
def test_a_feed_in_any_one_form(spark, tmp_path, form, written):
    times = [T(2024, 2, 1, 3, 4) + dt.timedelta(days=i, hours=i) for i in range(20)]
    (tmp_path / "tlm.csv").write_text(HEADER + "".join(f"{i},A,{t.strftime(form)},1,on,50,1\n" for i, t in enumerate(times)))
    (tmp_path / "trg.csv").write_text("CTS,PNID,NAME,VAL\n" + "".join(f"{t.strftime(form)} IST+0530,1,IGN_CYL,ON\n" for t in times))
    (tmp_path / "map.csv").write_text("ID,IDS\nA,[1]\n")
    (tmp_path / "syn.json").write_text("".join(json.dumps({"vehicleId": "A", "timestamp": t.strftime(form)}) + "\n" for t in times))
    paths = [str(tmp_path / name) for name in ("tlm.csv", "trg.csv", "map.csv", "syn.json")]
    formats = {name: written for name in ("tlm", "trg", "syn")} if written else None
    feeds = read_feeds(spark, *paths, formats=formats, lines=True)
    assert [r.TIMESTAMP for r in feeds.tlm.orderBy("row_ord").collect()] == times
    assert [r.CTS for r in feeds.trg.orderBy("row_ord").collect()] == times
    assert [r.timestamp for r in feeds.syn.orderBy("row_ord").collect()] == [t + dt.timedelta(hours=5.5) for t in times]
    assert feeds.notes == ()


def test_notes_become_findings(spark, tmp_path):
    (tmp_path / "tlm.csv").write_text(HEADER + "a,A,01/02/2024 10:00:00,1,on,50,1\nb,A,03/02/2024 10:00:00,1,off,50,1\n")
    (tmp_path / "trg.csv").write_text("CTS,PNID,NAME,VAL\n")
    (tmp_path / "map.csv").write_text("ID,IDS\nA,[1]\n")
    (tmp_path / "syn.json").write_text("[]")
    feeds = read_feeds(spark, *[str(tmp_path / n) for n in ("tlm.csv", "trg.csv", "map.csv", "syn.json")])
    with Flow(feeds, whole=True) as flow:
        (row,) = flow.findings.where("rule = 'FORMAT'").collect()
        assert (row.stage, row.item, row.n_rows) == (1, "TIMESTAMP", 2) and "could be swapped" in row.detail
        assert [r.TIMESTAMP for r in flow.tlm.orderBy("ID").collect()] == [T(2024, 1, 2, 10), T(2024, 3, 2, 10)]


def test_broken_records_and_lost_numbers(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        HEADER + 'a,A,2024-01-01,1 km,on,50%,NA\nb,A,2024-01-01,1,on,50\nc,A,2024-01-01,1,on,50,7,8\nd,A,2024-01-01,1,on,50,7\n'
    )
    feed = readers.read_tlm(spark, str(tmp_path / "t.csv"))
    rows = {r.ID: r for r in feed.collect()}
    assert [tuple(f) for f in rows["a"].faults] == [("number", "SPEED", "1 km"), ("number", "EV_BATTERY_LEVEL", "50%")]
    assert [tuple(f) for f in rows["b"].faults] == [("malformed", "", "b,A,2024-01-01,1,on,50")]
    assert [f.kind for f in rows["c"].faults] == ["malformed"] and rows["c"].ODOMETER == 7 and rows["d"].faults == []
    found = {(r.rule, r.item): r.n_rows for r in quality.tlm_findings(feed, feed, Params()).collect()}
    assert found[("MALFORMED", "")] == 2 and found[("NUMBER", "SPEED")] == found[("NUMBER", "EV_BATTERY_LEVEL")] == 1
    assert ("NUMBER", "ODOMETER") not in found
    rejected = quality.rejected_cells({"TLM": feed}).collect()
    assert len(rejected) == 4 and all(r.file.endswith("t.csv") for r in rejected)
    (tmp_path / "s.json").write_text('{"vehicleId": "A", "timestamp": "2024-01-01"}\n{"vehicleId": "B", "timest\n')
    syn = readers.read_syn(spark, str(tmp_path / "s.json"), lines=True)
    found = {r.rule: r.n_rows for r in quality.syn_findings(syn).collect()}
    assert found == {"MALFORMED": 1}


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text(HEADER + 'a,"A\nB",2024-01-01,1,"on\n",50,1\nb,C,2024-01-01,1,off,50,1\n')
    whole = readers.read_tlm(spark, str(tmp_path / "t.csv"), multi_line=True).collect()
    assert [(r.ID, r.VEHICLE_ID, r.IGNITION_STATUS, r.faults) for r in whole] == [("a", "A\nB", "on\n", []), ("b", "C", "off", [])]
    broken = readers.read_tlm(spark, str(tmp_path / "t.csv"))
    assert quality.rejected_cells({"TLM": broken}).where("kind = 'malformed'").count() == 3  # and not lost in silence


def counted(spark, df):
    """``df`` and an accumulator of the rows that were asked of it."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def test_run_reads_raw_feeds_once(spark, tmp_path):
    typed = DerivedFeeds(spark, f"{DATA}/sf0.001")
    (tlm, n_tlm), (trg, n_trg) = counted(spark, typed.tlm), counted(spark, typed.trg)
    feeds = readers.Feeds(tlm, trg, typed.map, typed.syn)
    with run(feeds, str(tmp_path / "out"), fmt="parquet") as flow:
        assert (n_tlm.value, n_trg.value) == (typed.tlm.count(), typed.trg.count())
        plain = Flow(typed)
        assert sorted(map(str, flow.findings.collect())) == sorted(map(str, plain.findings.collect()))
        assert flow.findings.where("rule = 'DQ-1'").count() == 1
        folder = flow.staging.folder
        assert os.listdir(folder)
    assert not os.path.exists(folder)


def test_each_flow_owns_its_tables(spark):
    first, second = Flow(DerivedFeeds(spark, f"{DATA}/sf0.001"), share=True), Flow(DerivedFeeds(spark, f"{DATA}/sf0.001"), share=True)
    n = first.sessions.count()
    assert second.sessions.count() == n
    first.close()
    first.close()
    assert not os.path.exists(first.staging.folder) and second.sessions.count() == n
    second.close()


def test_tables_go_to_the_run_at_hand(spark):
    rows = spark.range(5)
    with Staging(spark) as outer:
        with Staging(spark) as inner:
            stage(rows, "a")
        assert os.listdir(inner.folder)[0].startswith("a-") and not os.path.exists(outer.folder)
        assert new_path(spark, "b").startswith(outer.folder)
    assert not new_path(spark, "c").startswith(outer.folder)
    inner.close()
    outer.close()


@pytest.mark.parametrize("rows", [0, 7])
def test_figures_of_a_written_table(spark, rows):
    table, figures = measured(spark.range(rows).repartition(3), "x", {"n": "count(*)", "most": "max(id)"})
    assert table.count() == rows and [tuple(r) for r in figures.collect()] == [(rows, rows - 1 if rows else None)]


@pytest.mark.parametrize("n,distinct", [(1, 1), (2, 2), (5, 3), (1000, 20), (1001, 1001)])
def test_quantiles_equal_interpolation(spark, n, distinct):
    rng = random.Random(n)
    pool = [rng.uniform(-50, 50) for _ in range(distinct)]
    values = [rng.choice(pool) for _ in range(n)]
    (row,) = quantiles(spark.createDataFrame([(v,) for v in [*values, None]], "x double"), "x", [0.0, 0.25, 0.5, 0.75, 1.0]).collect()
    assert np.allclose(row.q, np.quantile(values, [0, 0.25, 0.5, 0.75, 1]))


def test_quantiles_of_nothing(spark):
    assert quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]).collect() == []


def test_quantiles_of_ten_million_distinct_values(spark):
    """The values lie in ranges; only a range that holds a wanted rank is searched, and no buffer holds them all."""
    n = 10_000_000
    rows = spark.range(n).selectExpr(f"(id * 7919) % {n} * 0.5D as x")
    (row,) = quantiles(rows, "x", [0.25, 0.5, 0.75]).collect()
    assert row.q == [(n - 1) * p * 0.5 for p in (0.25, 0.5, 0.75)]


def test_outliers_beyond_the_whiskers(spark):
    rows = spark.range(100).selectExpr("id", "if(id < 96, id % 10, id * 10) * 1D as x")
    assert sorted(r.id for r in outliers(rows, "x").collect()) == [96, 97, 98, 99]


def test_a_flow_runs_few_jobs(spark):
    """Steps are shared and their figures observed, so a query is a chain of few written tables."""
    context = spark.sparkContext
    context.setJobGroup("few-jobs", "all steps up to the sessions")
    try:
        with Flow(DerivedFeeds(spark, f"{DATA}/sf0.01"), share=True) as flow:
            flow.sessions.write.format("noop").mode("overwrite").save()
            tables = os.listdir(flow.staging.folder)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(tables) <= 14  # some for runs that fill whole slices
    assert len(context.statusTracker().getJobIdsForGroup("few-jobs")) <= 75

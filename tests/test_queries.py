"""Every named query against its SQL, and the end result under other slicings."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ampline.config import Params
from ampline.operators.charging import SESSION_COLUMNS
from ampline.plans.catalogue import QUERIES
from ampline.plans.pipeline import Flow
from ampline.sources.derived import DerivedFeeds
from tests.compare import DATA, differences, oracle_rows, spark_rows

SQL = oracle_sql()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    sf_dir = f"{DATA}/sf0.001"
    assert differences(spark_rows(queries()[name](spark, sf_dir)), oracle_rows(sf_dir, SQL[name])) == ""


def test_entry(spark):
    assert spark_rows(entry(spark)) == oracle_rows(f"{DATA}/sf0.001", SQL["charging_events"])


@pytest.mark.parametrize("p", [Params(slice_sec=60), Params(slice_sec=600, max_slice_rows=2)])
def test_slicing_does_not_change_the_result(spark, p):
    sf_dir = f"{DATA}/sf0.01"
    flow = Flow(DerivedFeeds(spark, sf_dir), p, share=True)
    assert differences(spark_rows(flow.sessions.select(SESSION_COLUMNS)), oracle_rows(sf_dir, SQL["charging_events"])) == ""


def test_every_offending_value_is_a_line(spark):
    """However many values a finding has, its row holds counts only, and the report shows each value."""
    from ampline.operators import cleaning, quality
    from ampline.sinks.writers import report_lines

    rows = [(i, "2024-01-01", 1, f"NAME{i}" if i < 1500 else "IGN_CYL", "x") for i in range(1502)]
    raw = spark.createDataFrame(rows, "row_ord bigint, CTS string, PNID bigint, NAME string, VAL string").selectExpr(
        "row_ord", "cast(CTS as timestamp_ntz) as CTS", "PNID", "NAME", "VAL"
    )
    findings = quality.trg_findings(raw, cleaning.clean_trg(raw))
    found = {r.rule: r for r in findings.collect()}
    assert found["DQ-9"].detail == "TRG: 1500 rows with unexpected NAME values (1500 different) — dropped."
    counts = quality.offending_triggers(raw).selectExpr("if(rule = 'name', 'DQ-9', 'DQ-10') as rule", "value", "n as n_rows")
    lines = [r.value for r in report_lines(findings, quality.shown_values(counts)).orderBy("line_no").collect()]
    names = sorted(f"    'NAME{i}' (1 rows)" for i in range(1500))
    assert lines == [f"1. {found['DQ-9'].detail}\n", *names, f"2. {found['DQ-10'].detail}\n", "    'x' (2 rows)"]


def test_session_zone_must_be_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError):
            Flow(DerivedFeeds(spark, f"{DATA}/sf0.001"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

"""Named queries over the feeds derived from the ``events`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ampline.config import Params
from ampline.operators import battery, charging, charts, cleaning, mapping, quality
from ampline.operators.charging import SESSION_COLUMNS
from ampline.operators.ignition import EVENT_COLUMNS
from ampline.plans.pipeline import Flow
from ampline.sinks import writers
from ampline.sources.derived import DerivedFeeds
from ampline.sources.readers import read_results
from ampline.sources.text_feeds import TextFeeds
from ampline.staging import new_path

Query = Callable[[SparkSession, str], DataFrame]
FINDING_OUTPUT = ["rule", "item", "n_rows", "detail"]


def _query(build: Callable[[Flow], DataFrame], share: bool = False, whole: bool = False) -> Query:
    return lambda spark, sf_dir: build(Flow(DerivedFeeds(spark, sf_dir), share=share, whole=whole))


def _on_sessions(build: Callable[[DataFrame, Params], DataFrame], passes: int = 1) -> Query:
    """A chart of the sessions; they are written first where it reads them more than once."""
    return _query(lambda f: build(f.sessions if passes == 1 else f.written_sessions, f.p), share=True)


def _findings(build: Callable[[Flow], DataFrame], share: bool = False) -> Query:
    return _query(lambda flow: build(flow).select(FINDING_OUTPUT), share)


def _round_trip(name: str, write: Callable[[Flow, str, str], None], fmt: str) -> Query:
    """A result table written to the shared folder and read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = new_path(spark, "results")
        write(Flow(DerivedFeeds(spark, sf_dir), share=True), f"{out}/{name}", fmt)
        return read_results(spark, out, fmt)[name]

    return query


def _line_from_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chart table made and written from a result folder, and read back."""
    out = new_path(spark, "results")
    flow = Flow(DerivedFeeds(spark, sf_dir), share=True)
    writers.write_sessions(flow.sessions, f"{out}/ChargingEvents", "parquet")
    writers.write_chart_tables(read_results(spark, out, "parquet"), f"{out}/charts", flow.p, "parquet")
    return _rounded(spark.read.parquet(f"{out}/charts/battery_line"), "battery")


def _report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as its text file has it, line by line."""
    path = f"{new_path(spark, 'results')}/data_quality_report"
    flow = Flow(DerivedFeeds(spark, sf_dir), whole=True)
    writers.write_report(flow.findings, quality.shown_values(flow.offending), path)
    return spark.read.text(path)


def _empty_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the sessions' file where no battery rises enough: its header."""
    flow = Flow(DerivedFeeds(spark, sf_dir), Params(rise_ign_on=1e9, rise_ign_off=1e9), share=True)
    path = f"{new_path(spark, 'results')}/ChargingEvents"
    writers.write_sessions(flow.sessions, path)
    return spark.read.text(path).distinct()


def _text_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings about records and numbers that could not be read."""
    feeds = TextFeeds(spark, sf_dir).faulty
    flow = Flow(feeds)
    found = quality.tlm_findings(feeds.tlm, flow.tlm, flow.p).unionByName(quality.trg_findings(feeds.trg, flow.trg))
    return found.where("rule in ('MALFORMED', 'NUMBER')").select(FINDING_OUTPUT)


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected cells with their text, and rejected records with their number of commas."""
    feeds = TextFeeds(spark, sf_dir).faulty
    commas = "cast(length(value) - length(replace(value, ',', '')) as string)"
    return quality.rejected_cells({"TLM": feeds.tlm, "TRG": feeds.trg, "MAP": feeds.map, "SYN": feeds.syn}).selectExpr(
        "feed", "kind", "item", f"if(kind = 'number', value, {commas}) as value"
    )


def _format_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is noted where all dates read the same with day and month swapped."""
    feeds = TextFeeds(spark, sf_dir).in_form("dd/MM/yyyy HH:mm:ss.SSSSSS")
    return quality.noted(spark, feeds.notes).select(FINDING_OUTPUT)


def _map_parsed(flow: Flow) -> DataFrame:
    return flow.parsed_map.selectExpr(
        "row_ord", "ID as vehicle_id", "IDS", "array_join(cast(pnids as array<string>), ',') as pnids"
    )


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.selectExpr(*[f"round({c}, 6) as {c}" if c in names else c for c in df.columns])


QUERIES: dict[str, Query] = {
    "tlm_clean": _query(lambda f: f.tlm),
    "trg_clean": _query(lambda f: f.trg),
    "syn_clean": _query(lambda f: f.syn),
    "map_parsed": _query(_map_parsed),
    "pnid_map": _query(lambda f: f.pnid_map),
    "trg_mapped": _query(lambda f: f.mapped),
    "unmapped_pnids": _query(lambda f: quality.unmapped_pnids(f.mapped)),
    "tlm_transitions": _query(lambda f: f.tlm_ignition.select(EVENT_COLUMNS)),
    "trg_transitions": _query(lambda f: f.trg_ignition.select(EVENT_COLUMNS)),
    "syn_events": _query(lambda f: f.syn_ignition.select(EVENT_COLUMNS)),
    "ignition_union": _query(lambda f: f.all_ignition),
    "fused_ignition": _query(lambda f: f.fused),
    "charging_status_events": _query(lambda f: f.status_events),
    "battery_timeline": _query(lambda f: f.timeline),
    "ignition_with_battery": _query(lambda f: f.ignition_with_battery, share=True),
    "status_with_battery": _query(lambda f: f.status_with_battery, share=True),
    "battery_association_rate": _query(
        lambda f: battery.association_rate(f.ignition_with_battery), share=True
    ),
    "charge_pairs": _query(lambda f: f.pairs, share=True),
    "charging_sessions_raw": _query(lambda f: f.raw_sessions, share=True),
    "charging_sessions_merged": _query(lambda f: f.merged_sessions, share=True),
    "charging_events": _query(lambda f: f.sessions.select(SESSION_COLUMNS), share=True),
    "dq_tlm": _findings(
        lambda f: quality.tlm_findings(f.feeds.tlm, f.tlm, f.p)
    ),
    "tlm_null_ratio": _query(lambda f: quality.null_ratios(f.tlm).drop("place")),
    "dq_trg": _findings(lambda f: quality.trg_findings(f.feeds.trg, f.trg)),
    "dq_map": _findings(lambda f: quality.map_findings(f.parsed_map)),
    "dq_syn": _findings(lambda f: quality.syn_findings(f.feeds.syn)),
    "dq_unmapped": _findings(lambda f: quality.unmapped_findings(f.mapped)),
    "dq_fusion": _findings(lambda f: quality.fusion_findings(f.all_ignition, f.fused), share=True),
    "dq_offending_values": _query(lambda f: quality.offending_values(f.feeds.trg, f.mapped)),
    "dq_report": _query(lambda f: f.report(), whole=True),
    "pipeline_counts": _query(lambda f: f.counts(), whole=True),
    "run_summary": _query(lambda f: f.summary(), whole=True),
    "tlm_text_clean": lambda spark, sf_dir: cleaning.clean_tlm(TextFeeds(spark, sf_dir).tlm).drop("row_ord"),
    "trg_text_clean": lambda spark, sf_dir: cleaning.clean_trg(TextFeeds(spark, sf_dir).trg).drop("row_ord"),
    "syn_text_clean": lambda spark, sf_dir: cleaning.clean_syn(TextFeeds(spark, sf_dir).syn).drop("row_ord"),
    "syn_lines_clean": lambda spark, sf_dir: cleaning.clean_syn(TextFeeds(spark, sf_dir).syn_lines).drop("row_ord"),
    "map_text_parsed": lambda spark, sf_dir: mapping.parse_map(TextFeeds(spark, sf_dir).map).selectExpr(
        "ID as vehicle_id", "array_join(cast(pnids as array<string>), ',') as pnids"
    ),
    "results_round_trip_csv": _round_trip(
        "IgnitionEvents", lambda f, path, fmt: writers.write_events(f.fused, ["prio", "ord1", "ord2"], path, fmt), "csv"
    ),
    "results_round_trip_parquet": _round_trip(
        "ChargingEvents", lambda f, path, fmt: writers.write_sessions(f.sessions, path, fmt), "parquet"
    ),
    "status_round_trip_csv": _round_trip(
        "ChargingStatusEvents", lambda f, path, fmt: writers.write_events(f.status_events, ["ord1", "ord2"], path, fmt), "csv"
    ),
    "report_file": _report_file,
    "empty_sessions_file": _empty_sessions,
    "status_battery_default": _query(lambda f: charging.with_battery_column(f.status_events)),
    "tlm_lines_clean": lambda spark, sf_dir: cleaning.clean_tlm(TextFeeds(spark, sf_dir).tlm_lines).drop("row_ord"),
    "tlm_inferred_clean": lambda spark, sf_dir: cleaning.clean_tlm(
        TextFeeds(spark, sf_dir).in_form("d MMM yyyy h:mm:ss.SSSSSS a").tlm
    ).drop("row_ord"),
    "trg_inferred_clean": lambda spark, sf_dir: cleaning.clean_trg(
        TextFeeds(spark, sf_dir).in_form("dd.MM.yyyy HH:mm:ss.SSSSSS").trg
    ).drop("row_ord"),
    "dq_text_faults": _text_faults,
    "dq_formats": _format_findings,
    "rejected_cells": _rejected,
    "charts_from_results": _line_from_results,
    "viz_ignition_timeline": _query(lambda f: charts.ignition_timeline(f.fused), share=True),
    "viz_duration_hist": _on_sessions(
        lambda s, p: _rounded(charts.duration_hist(s, p), "bin_start", "bin_end"), passes=4
    ),
    "viz_duration_kde": _on_sessions(lambda s, p: _rounded(charts.duration_kde(s, p), "x", "density"), passes=2),
    "viz_gain_box": _on_sessions(
        lambda s, p: _rounded(charts.gain_box(s), "q1", "median", "q3", "whisker_low", "whisker_high"), passes=3
    ),
    "viz_gain_outliers": _on_sessions(lambda s, p: charts.gain_outliers(s), passes=2),
    "viz_gain_outliers_narrow": _on_sessions(lambda s, p: charts.gain_outliers(s, 0.25), passes=2),
    "viz_duration_outliers": _on_sessions(lambda s, p: charts.duration_outliers(s), passes=2),
    "viz_sessions_per_vehicle": _on_sessions(lambda s, p: charts.sessions_per_vehicle(s)),
    "viz_duration_vs_gain": _on_sessions(lambda s, p: _rounded(charts.duration_vs_gain(s), "duration_min")),
    "viz_hour_heatmap": _on_sessions(lambda s, p: charts.hour_heatmap(s)),
    "viz_battery_points": _on_sessions(lambda s, p: charts.battery_points(s)),
    "viz_battery_line": _on_sessions(lambda s, p: _rounded(charts.battery_line(s), "battery")),
}

"""The whole analysis as one flow of DataFrames, from raw feeds to result tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampline.config import Params, require_utc
from ampline.operators import battery, charging, cleaning, fusion, ignition, mapping, quality
from ampline.operators.slices import HotCells, find_hot_cells
from ampline.sinks import writers
from ampline.sources.derived import DerivedFeeds
from ampline.sources.readers import Feeds, read_feeds, with_faults
from ampline.staging import Staging, measured, stage

__all__ = ["Flow", "read_feeds", "run"]


def step(build: Callable[[Flow], DataFrame]) -> cached_property:
    """A step of a flow, built once; the tables that it writes go to the flow's folder."""

    @wraps(build)
    def within(flow: Flow):
        with flow.staging:
            return build(flow)

    return cached_property(within)


class Flow:
    """Lazily built steps of one run.

    ``share`` writes the tables that several steps read: of the telemetry the rows and columns
    later steps need, or with ``whole`` all of the raw and the cleaned feed, of which the quality
    findings' figures are taken while they are written.

    The written tables lie in a folder of the flow; ``close`` removes it, and no step's table can be read then.
    """

    def __init__(self, feeds: Feeds | DerivedFeeds, params: Params | None = None, share: bool = False, whole: bool = False):
        self.feeds = feeds
        self.p = params or Params()
        self._share = share or whole
        self._whole = whole
        require_utc(SparkSession.active())
        self.staging = Staging(SparkSession.active())

    def close(self) -> None:
        self.staging.close()

    def __enter__(self) -> Flow:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def _shared(self, df: DataFrame, label: str) -> DataFrame:
        return stage(df, label) if self._share else df

    def _measured(self, df: DataFrame, label: str, figures: dict[str, str]) -> tuple[DataFrame, DataFrame]:
        return measured(df, label, figures) if self._whole else (df, quality.figures_of(df, figures))

    @step
    def _raw_tlm(self) -> tuple[DataFrame, DataFrame]:
        """The raw telemetry and its figures; parsed once, into typed columns that later passes read selectively."""
        return self._measured(with_faults(self.feeds.tlm), "raw-tlm", quality.TLM_RAW)

    @step
    def _raw_trg(self) -> tuple[DataFrame, DataFrame]:
        return self._measured(with_faults(self.feeds.trg), "raw-trg", quality.TRG_RAW)

    @step
    def _clean_tlm(self) -> tuple[DataFrame, DataFrame]:
        return self._measured(cleaning.clean_tlm(self._raw_tlm[0]), "tlm", quality.TLM_CLEAN)

    @property
    def tlm(self) -> DataFrame:
        return self._clean_tlm[0]

    @step
    def signals(self) -> DataFrame:
        """What later steps need of the telemetry: rows with an on/off status or a battery level."""
        useful = self.tlm.where(
            "VEHICLE_ID is not null and (IGNITION_STATUS in ('on', 'off') or EV_BATTERY_LEVEL is not null)"
        )
        columns = ["row_ord", "VEHICLE_ID", "TIMESTAMP", "IGNITION_STATUS", "EV_BATTERY_LEVEL"]
        return useful.select(columns) if self._whole else self._shared(useful.select(columns), "signals")

    @step
    def trg(self) -> DataFrame:
        return cleaning.clean_trg(self._raw_trg[0])

    @step
    def syn(self) -> DataFrame:
        return cleaning.clean_syn(self.feeds.syn)

    @step
    def parsed_map(self) -> DataFrame:
        return mapping.parse_map(self.feeds.map)

    @step
    def pnid_map(self) -> DataFrame:
        return mapping.pnid_map(self.parsed_map)

    @step
    def mapped(self) -> DataFrame:
        """Triggers with their vehicle: one lookup for all three uses."""
        return self._shared(mapping.with_vehicle(self.trg, self.pnid_map), "triggers")

    @step
    def hot(self) -> HotCells | None:
        """Crowded vehicle-hours of all rows that are put in order: status rows of both recording sources,
        synthetic events without copies, plug events and battery readings. Any cut is right; later steps have fewer rows."""
        rows = ignition.tlm_status(self.signals).unionByName(ignition.trg_status(self.mapped))
        synthetic = self.syn_ignition.select("vehicle_id", "event_ts").distinct()
        everything = rows.select("vehicle_id", "event_ts").unionByName(synthetic).unionByName(
            self.status_events.select("vehicle_id", "event_ts")
        ).unionByName(self.timeline.selectExpr("vehicle_id", "ts as event_ts"))
        return find_hot_cells(everything, self.p)

    @step
    def hot_tlm(self) -> HotCells | None:
        """Of the telemetry alone; counted on raw rows, whose counts are an upper bound."""
        rows = self._raw_tlm[0].where(
            f"{cleaning.STATUS} in ('on', 'off') and TIMESTAMP is not null and VEHICLE_ID is not null"
        )
        return find_hot_cells(rows.selectExpr("VEHICLE_ID as vehicle_id", "TIMESTAMP as event_ts"), self.p)

    @step
    def changes(self) -> DataFrame:
        """Status changes of both recording sources, found in one pass."""
        rows = ignition.tlm_status(self.signals).unionByName(ignition.trg_status(self.mapped))
        return ignition.ignition_changes(rows, self.hot, self.p)

    @step
    def tlm_ignition(self) -> DataFrame:
        return ignition.ignition_changes(ignition.tlm_status(self.tlm), self.hot_tlm, self.p)

    @step
    def trg_ignition(self) -> DataFrame:
        rows = ignition.trg_status(self.mapped)
        return ignition.ignition_changes(rows, find_hot_cells(rows, self.p), self.p)

    @step
    def syn_ignition(self) -> DataFrame:
        return ignition.syn_ignition(self.syn)

    @step
    def all_ignition(self) -> DataFrame:
        return self.changes.unionByName(self.syn_ignition)

    @step
    def fused(self) -> DataFrame:
        return self._shared(fusion.fuse(self.changes, self.syn_ignition, self.hot, self.p), "fused")

    @step
    def status_events(self) -> DataFrame:
        return battery.charging_status(self.mapped)

    @step
    def timeline(self) -> DataFrame:
        return battery.battery_timeline(self.signals, self.mapped)

    @step
    def ignition_with_battery(self) -> DataFrame:
        return battery.attach_battery(self.fused, self.timeline, self.p, self.hot is not None)

    @step
    def status_with_battery(self) -> DataFrame:
        return battery.attach_battery(self.status_events, self.timeline, self.p)

    @step
    def candidates(self) -> DataFrame:
        """Ignition and status events with battery, looked up in one pass over the timeline."""
        sequence = charging.event_sequence(self.fused, self.status_events)
        return battery.attach_battery(sequence, self.timeline, self.p, self.hot is not None)

    @step
    def pairs(self) -> DataFrame:
        return charging.charge_pairs(self.candidates, self.hot, self.p)

    @step
    def raw_sessions(self) -> DataFrame:
        return charging.sessions_before_merge(self.pairs, self.p)

    @step
    def merged_sessions(self) -> DataFrame:
        return charging.merge_sessions(self.raw_sessions, self.hot, self.p)

    @step
    def sessions(self) -> DataFrame:
        return charging.charging_events(self.merged_sessions, self.p)

    @step
    def written_sessions(self) -> DataFrame:
        """The sessions for several readers."""
        return stage(self.sessions, "charging-events")

    @step
    def findings(self) -> DataFrame:
        trigger_totals, unmapped_totals = quality.rule_totals(self.offending)
        n_triggers = self.mapped.agg(F.expr("count(*) as n"))
        parts = [
            quality.tlm_findings_from(self._raw_tlm[1], self._clean_tlm[1], self.p),
            quality.trg_findings_from(self._raw_trg[1], n_triggers, trigger_totals),
            quality.map_findings(self.parsed_map),
            quality.map_losses(self.feeds.map),
            quality.syn_findings(self.feeds.syn),
            quality.unmapped_findings_from(unmapped_totals),
            quality.fusion_findings(self.all_ignition, self.fused),
        ]
        if notes := getattr(self.feeds, "notes", ()):
            parts.append(quality.noted(SparkSession.active(), notes))
        everything = parts[0]
        for part in parts[1:]:
            everything = everything.unionByName(part)
        return everything

    @step
    def offending(self) -> DataFrame:
        return self._shared(quality.offending_values(self._raw_trg[0], self.mapped), "offending")

    @step
    def rejected(self) -> DataFrame:
        """Records and cells of the feeds that could not be read."""
        return quality.rejected_cells(
            {"TLM": self._raw_tlm[0], "TRG": self._raw_trg[0], "MAP": self.feeds.map, "SYN": self.feeds.syn}
        )

    def report(self) -> DataFrame:
        with self.staging:
            return writers.report_lines(self.findings, quality.shown_values(self.offending))

    def counts(self) -> DataFrame:
        """Rows and distinct entities per step: step, n_rows, n_entities."""
        steps = [
            ("tlm", self.tlm, "VEHICLE_ID"),
            ("trg", self.trg, "PNID"),
            ("map", self.pnid_map, "vehicle_id"),
            ("syn", self.syn, "vehicle_id"),
            ("tlm_ignition", self.changes.where("source = 'TLM'"), "vehicle_id"),
            ("trg_ignition", self.changes.where("source = 'TRG'"), "vehicle_id"),
            ("syn_ignition", self.syn_ignition, "vehicle_id"),
            ("fused_ignition", self.fused, "vehicle_id"),
            ("charging_status", self.status_events, "vehicle_id"),
            ("battery_timeline", self.timeline, "vehicle_id"),
            ("charging_events", self.sessions, "vehicle_id"),
        ]
        parts = [
            df.agg(F.count("*").alias("n_rows"), F.count_distinct(entity).alias("n_entities")).select(
                F.lit(step).alias("step"), "n_rows", "n_entities"
            )
            for step, df, entity in steps
        ]
        table = parts[0]
        for part in parts[1:]:
            table = table.unionByName(part)
        return table

    def summary(self) -> DataFrame:
        """The four totals of a run: metric, value."""
        totals = [
            ("Ignition Events", self.fused),
            ("Charging Status Events", self.status_events),
            ("Charging Events", self.sessions),
            ("Data Quality Findings", self.findings),
        ]
        parts = [
            df.agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "value") for name, df in totals
        ]
        return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def run(feeds: Feeds, out_dir: str, params: Params | None = None, fmt: str = "csv") -> Flow:
    """Compute everything once and write the three tables, the report, its values and the rejected cells.

    The text feeds of telemetry and triggers are read once. ``close`` the returned flow when its tables are not needed any more.
    """
    flow = Flow(feeds, params, whole=True)
    with flow.staging:
        writers.write_events(flow.fused, ["prio", "ord1", "ord2"], f"{out_dir}/IgnitionEvents", fmt)
        writers.write_sessions(flow.sessions, f"{out_dir}/ChargingEvents", fmt)
        writers.write_events(flow.status_events, ["ord1", "ord2"], f"{out_dir}/ChargingStatusEvents", fmt)
        writers.write_report(flow.findings, quality.shown_values(flow.offending), f"{out_dir}/data_quality_report")
        writers.write_table(flow.offending, f"{out_dir}/offending_values", fmt)
        writers.write_table(flow.rejected, f"{out_dir}/rejected_cells", fmt)
    return flow

"""Data-quality findings: one row per finding that fires, and the offending values and rows behind them.

Counts are figures: SQL aggregates by name. They are taken of a table by an aggregate (``figures_of``), or while it is
written (``staging.measured``), and then no further pass reads its rows.

Columns: stage, k1 and k2 (report order), rule, item (vehicle, PNID or column, else empty),
n_rows and detail (the report line).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampline.config import Params
from ampline.functions.scalars import as_place, file_chunk, file_place, python_quote
from ampline.operators.cleaning import BATTERY, SPEED, STATUS, TRIGGER_FAULT
from ampline.operators.mapping import claims
from ampline.operators.slices import in_slice, with_context
from ampline.sources.readers import Note, with_faults

# Fixed values, here and in the texts below: checked columns, rule numbers, wording of the report.
CHECKED_COLUMNS = ["SPEED", "IGNITION_STATUS", "EV_BATTERY_LEVEL", "ODOMETER"]
FAULT_STAGES = {"name": 9, "ignition": 10, "charge_level": 11, "charge_status": 12}
DROPPED = "— dropped."


def _finding(
    rows: DataFrame, stage: int, n: str, detail: str,
    item: str = "''", k1: str | None = None, k2: str = "0", rule: str | None = None,
) -> DataFrame:
    return rows.selectExpr(
        f"{stage} as stage", f"{k1 or as_place('0')} as k1", f"cast({k2} as bigint) as k2",
        f"'{rule or f'DQ-{stage}'}' as rule", f"cast({item} as string) as item",
        f"cast({n} as bigint) as n_rows", f"{detail} as detail",
    )


def _entry(stage: int, count: str, detail: str, item: str = "", place: int = 0, rule: str | None = None) -> str:
    return (
        f"named_struct('stage', {stage}, 'k1', {as_place(str(place))}, 'k2', 0L, 'rule', '{rule or f'DQ-{stage}'}', "
        f"'item', '{item}', 'n_rows', cast({count} as bigint), 'detail', {detail})"
    )


def _counted(totals: DataFrame, entries: list[tuple[int, str, str]], more: list[str] = []) -> DataFrame:  # noqa: B006
    """One finding per (stage, count column, text with one %d) and further entry, zero counts left out."""
    rows = [_entry(stage, count, f'format_string("{text}", {count})') for stage, count, text in entries]
    return totals.selectExpr(f"inline(array({', '.join([*rows, *more])}))").where("n_rows > 0")


def figures_of(df: DataFrame, figures: dict[str, str]) -> DataFrame:
    """The figures of a table, as one row."""
    return df.selectExpr(*[f"{value} as {name}" for name, value in figures.items()])


def _faulty(kind: str, item: str = "") -> str:
    return f"exists(faults, f -> f.kind = '{kind}' and f.item = '{item}')"


MALFORMED = _faulty("malformed")
TLM_NUMBERS = ["SPEED", "EV_BATTERY_LEVEL", "ODOMETER"]
TLM_RAW = {
    "bad_time": "count_if(TIMESTAMP is null)",
    "unknown": f"count_if(TIMESTAMP is not null and {STATUS} = 'unknown')",
    "high": f"count_if(TIMESTAMP is not null and {BATTERY} > 100)",
    "negative": f"count_if(TIMESTAMP is not null and {BATTERY} < 0)",
    "slow": f"count_if(TIMESTAMP is not null and {SPEED} < 0)",
    "timed": "count_if(TIMESTAMP is not null)",
    "malformed": f"count_if({MALFORMED})",
    **{f"lost_{name}": f"count_if({_faulty('number', name)})" for name in TLM_NUMBERS},
}
TLM_CLEAN = {
    "n": "count(*)", "no_vehicle": "count_if(VEHICLE_ID is null)", **{name: f"count({name})" for name in CHECKED_COLUMNS},
}
TRG_RAW = {
    "bad_time": "count_if(CTS is null)",
    "valid": f"count_if(CTS is not null and ({TRIGGER_FAULT}) is null)",
    "malformed": f"count_if({MALFORMED})",
    "lost_PNID": f"count_if({_faulty('number', 'PNID')})",
}


def _lost(tag: str, stage: int, names: list[str]) -> list[str]:
    """Records and cells that could not be read as they should; findings of this engine, behind the others of the feed."""
    malformed = f"format_string('{tag}: %d malformed records — extra cells dropped, missing ones empty.', malformed)"
    number = (
        lambda name: f"""format_string("{tag}: Column '{name}' has %d unreadable numbers — treated as missing.", lost_{name})"""
    )
    return [
        _entry(stage, "malformed", malformed, place=100, rule="MALFORMED"),
        *[_entry(stage, f"lost_{n}", number(n), n, 101 + i, "NUMBER") for i, n in enumerate(names)],
    ]


def tlm_findings(raw: DataFrame, clean: DataFrame, p: Params) -> DataFrame:
    return tlm_findings_from(figures_of(with_faults(raw), TLM_RAW), figures_of(clean, TLM_CLEAN), p)


def tlm_findings_from(raw: DataFrame, clean: DataFrame, p: Params) -> DataFrame:
    """Findings of the telemetry from the figures of its raw and cleaned rows."""
    totals = raw.select("*", clean.selectExpr("struct(*) as c").scalar().alias("c")).selectExpr(
        "*", "timed - c.n as repeated", "c.no_vehicle as no_vehicle"
    )
    sparse = [
        _entry(
            7, f"if(100 * (c.n - c.{name}) / nullif(c.n, 0) > {p.null_alert_pct}, c.n - c.{name}, 0)",
            f"""format_string("TLM: Column '{name}' is %.1f%% null (%s/%s) — sparse but usable.", """
            f"rint(1000 * (c.n - c.{name}) / nullif(c.n, 0)) / 10, format_number(c.n - c.{name}, 0), format_number(c.n, 0))",
            name, place,
        )
        for place, name in enumerate(CHECKED_COLUMNS)
    ]
    return _counted(totals, [
        (1, "bad_time", f"TLM: %d rows with unparseable timestamps {DROPPED}"),
        (2, "unknown", "TLM: %d rows have IGNITION_STATUS='unknown' — treated as missing."),
        (3, "high", "TLM: %d battery readings > 100 %% — capped at 100."),
        (4, "negative", "TLM: %d negative battery readings — set to NaN."),
        (5, "slow", "TLM: %d negative speed readings — set to 0."),
        (6, "repeated", "TLM: %d duplicate row IDs — deduplicated."),
    ], [*sparse, _no_vehicle("TLM", 7), *_lost("TLM", 7, TLM_NUMBERS)])


def _no_vehicle(tag: str, stage: int) -> str:
    """Rows without a vehicle id are dropped by this engine, so they get a finding of their own."""
    detail = f"format_string('{tag}: %d rows without a vehicle id {DROPPED}', no_vehicle)"
    return _entry(stage, "no_vehicle", detail, place=99, rule="NO-VEHICLE")


def null_ratios(clean: DataFrame) -> DataFrame:
    """place, column_name, n_null, n_rows, pct_null for the checked columns of the cleaned telemetry."""
    return null_ratios_from(figures_of(clean, TLM_CLEAN))


def null_ratios_from(totals: DataFrame) -> DataFrame:
    rows = ", ".join(
        f"named_struct('place', {i}, 'column_name', '{c}', 'n_null', n - {c}, 'n_rows', n)"
        for i, c in enumerate(CHECKED_COLUMNS)
    )
    return totals.selectExpr(f"inline(array({rows}))").where("n_rows > 0").selectExpr(
        "*", "100 * n_null / n_rows as pct_null"
    )


def rule_totals(offending: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``value_totals`` of the triggers' faults and of the unmapped PNIDs, from the table of all offending values."""
    fault = " ".join(f"when 'DQ-{number}' then '{name}'" for name, number in FAULT_STAGES.items())
    totals = value_totals(offending.withColumnRenamed("n_rows", "n"))
    faults = totals.selectExpr(f"case rule {fault} end as rule", "n_rows", "n_values").where("rule is not null")
    unmapped = totals.where("rule in ('DQ-18', 'DQ-20')").selectExpr(
        "if(rule = 'DQ-18', 'IGN_CYL', 'EV_CHARGE_STATE') as rule", "n_rows", "n_values"
    )
    return faults, unmapped


def value_totals(counts: DataFrame) -> DataFrame:
    """Per rule: n_rows and n_values. ``counts``: rule, value, n; the values themselves stay rows."""
    return counts.groupBy("rule").agg(F.expr("sum(n) as n_rows"), F.expr("count(*) as n_values"))


def offending_triggers(raw: DataFrame) -> DataFrame:
    """rule, value, n for rejected trigger rows."""
    return (
        raw.where("CTS is not null").selectExpr(f"{TRIGGER_FAULT} as rule", "NAME", "VAL")
        .where("rule is not null").selectExpr("rule", "if(rule = 'name', NAME, VAL) as value")
        .groupBy("rule", "value").agg(F.expr("count(*) as n"))
    )


def trg_findings(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """``clean``: the triggers without bad rows and copies, with or without their vehicles."""
    return trg_findings_from(
        figures_of(with_faults(raw), TRG_RAW), clean.agg(F.expr("count(*) as n")), value_totals(offending_triggers(raw))
    )


def trg_findings_from(raw: DataFrame, clean: DataFrame, totals: DataFrame) -> DataFrame:
    """Findings of the triggers from figures of raw rows, the number ``n`` of clean ones and totals by rule."""
    rows = raw.select("*", (F.col("valid") - clean.select("n").scalar()).alias("repeated"))
    found = _counted(rows, [
        (8, "bad_time", f"TRG: %d rows with unparseable timestamps {DROPPED}"),
        (13, "repeated", "TRG: %d exact duplicate rows — deduplicated."),
    ], _lost("TRG", 13, ["PNID"]))
    stage = " ".join(f"when '{name}' then {number}" for name, number in FAULT_STAGES.items())
    text = (
        "case rule when 'name' then format_string('rows with unexpected NAME values (%d different)', n_values) "
        "when 'ignition' then format_string('IGN_CYL rows with unexpected VAL (%d different)', n_values) "
        "when 'charge_level' then 'CHARGE_STATE rows with non-numeric VAL' "
        "else format_string('EV_CHARGE_STATE rows with unexpected VAL (%d different)', n_values) end"
    )
    rejected = totals.selectExpr(
        f"case rule {stage} end as stage", f"{as_place('0')} as k1", "0L as k2",
        f"concat('DQ-', case rule {stage} end) as rule", "'' as item", "n_rows",
        f"format_string('TRG: %d %s {DROPPED}', n_rows, {text}) as detail",
    )
    return found.unionByName(rejected)


def map_findings(parsed: DataFrame) -> DataFrame:
    vehicle, place = "coalesce(ID, 'nan')", file_place(parsed, "row_ord")
    missing = _finding(
        parsed.where("IDS is null"), 14, "1",
        f"format_string('MAP: Vehicle %s has no PNIDs — will get events only from TLM/SYN.', {vehicle})",
        vehicle, place,
    )
    unread = _finding(
        parsed.where("IDS is not null and pnids is null"), 14, "1",
        f"format_string('MAP: Could not parse PNIDs for vehicle %s: %s', {vehicle}, {python_quote('IDS')})",
        vehicle, place, rule="DQ-15",
    )
    entries = claims(parsed).selectExpr("row_ord", "pos", "pnid", "coalesce(vehicle_id, 'nan') as vehicle")
    entries = entries.selectExpr("*", f"{file_chunk(entries, 'row_ord')} as slice")
    order, key = ["row_ord", "pos"], ("pnid",)
    again = with_context(entries, order, before={"carried": "vehicle"}, key=key).selectExpr(
        "*", f"coalesce(lag(vehicle) {in_slice(order, key)}, carried) as previous"
    ).where("previous is not null")
    overwritten = _finding(
        again, 16, "1",
        "format_string('MAP: PNID %d maps to multiple vehicles: %s and %s. Using latest.', pnid, previous, vehicle)",
        "pnid", place, "pos",
    )
    return missing.unionByName(unread).unionByName(overwritten)


def map_losses(raw: DataFrame) -> DataFrame:
    """Malformed records of the mapping."""
    return _counted(figures_of(with_faults(raw), {"malformed": f"count_if({MALFORMED})"}), [], _lost("MAP", 16, []))


def syn_findings(raw: DataFrame) -> DataFrame:
    totals = with_faults(raw).selectExpr(
        f"count_if(timestamp is null and not {MALFORMED}) as bad_time", f"count_if({MALFORMED}) as malformed",
        "count_if(timestamp is not null and vehicleId is null) as no_vehicle",
    )
    bad = [(17, "bad_time", f"SYN: %d rows with unparseable timestamps {DROPPED}")]
    malformed = f"format_string('SYN: %d malformed records {DROPPED}', malformed)"
    return _counted(totals, bad, [
        _no_vehicle("SYN", 17), _entry(17, "malformed", malformed, place=100, rule="MALFORMED"),
    ])


def noted(spark: SparkSession, notes: tuple[Note, ...]) -> DataFrame:
    """What the readers noted, as findings."""
    rows = spark.createDataFrame(list(notes), "stage int, item string, n_rows bigint, detail string")
    return rows.selectExpr(
        "stage", f"{as_place('110')} as k1", "0L as k2", "'FORMAT' as rule", "item", "n_rows", "detail"
    )


def rejected_cells(feeds: dict[str, DataFrame]) -> DataFrame:
    """Every record and cell that could not be read: feed, kind, item (column), file and value."""
    rows = [
        with_faults(feed).selectExpr(
            f"'{name}' as feed", f"({file_place(feed, 'row_ord')}).file as file", "inline(faults)"
        ).select("feed", "kind", "item", "file", "value")
        for name, feed in feeds.items()
    ]
    table = rows[0]
    for more in rows[1:]:
        table = table.unionByName(more)
    return table


def unmapped_pnids(mapped: DataFrame) -> DataFrame:
    """rule (trigger name), value (PNID), n for ignition and plug triggers without a vehicle."""
    return (
        mapped.where("vehicle_id is null and NAME in ('IGN_CYL', 'EV_CHARGE_STATE')")
        .selectExpr("NAME as rule", "PNID as value").groupBy("rule", "value").agg(F.expr("count(*) as n"))
    )


def unmapped_findings(mapped: DataFrame) -> DataFrame:
    return unmapped_findings_from(value_totals(unmapped_pnids(mapped)))


def unmapped_findings_from(totals: DataFrame) -> DataFrame:
    stage = "if(rule = 'IGN_CYL', 18, 20)"
    tag = "if(rule = 'IGN_CYL', 'IGN', 'ChargeStatus')"
    return totals.selectExpr(
        f"{stage} as stage", f"{as_place('0')} as k1", "0L as k2",
        f"concat('DQ-', {stage}) as rule", "'' as item", "n_rows",
        f"format_string('TRG→%s: %d %s rows with unmapped PNIDs (%d different) {DROPPED}', {tag}, n_rows, rule, n_values) as detail",
    )


def fusion_findings(before: DataFrame, after: DataFrame) -> DataFrame:
    sizes = before.agg(F.expr("count(*) as n")).select(
        (F.col("n") - after.agg(F.expr("count(*)")).scalar()).alias("removed")
    )
    text = "Ignition fusion: %d near-duplicate events removed (same vehicle + event within 10 s)."
    return _counted(sizes, [(19, "removed", text)])


def offending_values(raw_trg: DataFrame, mapped: DataFrame) -> DataFrame:
    """All values named in findings: rule, value, n_rows."""
    stage = " ".join(f"when '{name}' then {number}" for name, number in FAULT_STAGES.items())
    triggers = offending_triggers(raw_trg).selectExpr(
        f"concat('DQ-', case rule {stage} end) as rule", "value", "n as n_rows"
    )
    pnids = unmapped_pnids(mapped).selectExpr(
        "if(rule = 'IGN_CYL', 'DQ-18', 'DQ-20') as rule", "cast(value as string) as value", "n as n_rows"
    )
    return triggers.unionByName(pnids)


def shown_values(offending: DataFrame) -> DataFrame:
    """rule, shown, n_rows: offending values as the report shows them, texts in quotes."""
    text = f"if(rule in ('DQ-18', 'DQ-20'), value, {python_quote('value')})"
    return offending.selectExpr("rule", f"coalesce({text}, 'nan') as shown", "n_rows")

"""The four raw feeds derived from an ``events`` table (event_id, ts, user_id, event_type, value, props).

Time is compressed by 240, so that the 10 s and 300 s rules meet real neighbours.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ampline.functions.scalars import micros, ntz_from_micros

START_US = 1704067200000000
SQUEEZE = 240


def _base(events: DataFrame, kinds: str) -> DataFrame:
    return events.where(f"event_type in ({kinds})").selectExpr(
        "event_id as e", "user_id as u", "event_type as kind", "value", "props",
        f"{START_US} + ({micros('ts')} - {START_US}) div {SQUEEZE} as us",
    )


def _copied(rows: DataFrame, every: int) -> DataFrame:
    """A second copy (d = 1) of each row whose number divides by ``every``."""
    return rows.selectExpr("*", f"explode(if(e % {every} = 0, array(0, 1), array(0))) as d")


def derived_tlm(events: DataFrame) -> DataFrame:
    return _copied(_base(events, "'click', 'view', 'purchase'"), 50).selectExpr(
        "e * 2 + d as row_ord",
        "cast(e as string) as ID",
        "concat('V', u) as VEHICLE_ID",
        f"if(e % 97 <> 0, {ntz_from_micros('us')}, null) as TIMESTAMP",
        "if(kind = 'view', value - 10, null) as SPEED",
        "case when kind = 'click' then ' On ' when kind = 'view' then 'OFF' "
        "when e % 2 = 0 then 'Unknown' end as IGNITION_STATUS",
        "if(kind <> 'view', value - 5, null) as EV_BATTERY_LEVEL",
        "if(e % 4 = 0, value * 100, null) as ODOMETER",
    )


def derived_trg(events: DataFrame) -> DataFrame:
    # k comes out of the generator, so that filters on it do not parse the JSON text again.
    k = "cast(get_json_object(props, '$.k') as int) as k"
    rows = _base(events, "'signup', 'error'").selectExpr(
        "*", f"inline(transform(if(e % 40 = 0, array(0, 1), array(0)), d -> struct(d, {k})))"
    )
    return rows.selectExpr(
        "e * 2 + d as row_ord",
        f"if(e % 89 <> 0, {ntz_from_micros('us')}, null) as CTS",
        "u * 2 + e % 2 as PNID",
        "case when kind = 'signup' then 'CHARGE_STATE' when k < 60 then 'IGN_CYL' "
        "when k < 90 then 'EV_CHARGE_STATE' else 'DOOR' end as NAME",
        "case when kind = 'signup' then case k when 13 then 'n/a' when 17 then '120.5' when 19 then '-3' "
        "else cast(k as string) end "
        "when k = 31 then 'CRANK' when k < 60 then if(k % 2 = 0, 'ON', 'OFF') "
        "when k < 90 then array('Active', 'Aborted', 'Complete', 'Completed', 'Abort')[k % 5] "
        "else 'x' end as VAL",
    )


def derived_map(events: DataFrame) -> DataFrame:
    ids = (
        "case u % 15 when 14 then null when 13 then 'broken[' "
        "when 4 then format_string('[%d,%d,%d]', u * 2, u * 2 + 1, u * 2 + 2) "
        "else format_string('[%d,%d]', u * 2, u * 2 + 1) end"
    )
    late = f"named_struct('row_ord', u * 2 + 1, 'IDS', {ids})"
    early = "named_struct('row_ord', u * 2, 'IDS', '[]')"
    return (
        events.selectExpr("user_id as u").distinct()
        .selectExpr("concat('V', u) as ID", f"inline(if(u % 15 = 3, array({early}, {late}), array({late})))")
        .select("row_ord", "ID", "IDS")
    )


def derived_syn(events: DataFrame) -> DataFrame:
    third = (
        "named_struct('row_ord', e * 2, 'vehicleId', concat(if(e % 30 = 0, 'X', 'V'), u), 'us', us + 3000000)"
    )
    fifth = "named_struct('row_ord', e * 2 + 1, 'vehicleId', concat('V', u), 'us', us + (e % 20) * 1000000)"
    both = f"array(if(e % 3 = 0, {third}, null), if(e % 5 = 0, {fifth}, null))"
    return _base(events, "'view'").selectExpr(f"inline(filter({both}, x -> x is not null))").selectExpr(
        "row_ord", "vehicleId", f"if(row_ord % 74 <> 0, {ntz_from_micros('us')}, null) as timestamp", "'ignitionOff' as type"
    )


class DerivedFeeds:
    """The four feeds, each defined when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._events = spark.read.parquet(f"{sf_dir}/events.parquet")

    @cached_property
    def tlm(self) -> DataFrame:
        return derived_tlm(self._events)

    @cached_property
    def trg(self) -> DataFrame:
        return derived_trg(self._events)

    @cached_property
    def map(self) -> DataFrame:
        return derived_map(self._events)

    @cached_property
    def syn(self) -> DataFrame:
        return derived_syn(self._events)

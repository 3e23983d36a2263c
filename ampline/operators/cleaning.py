"""Cleaning of the raw feeds: bad times, odd values, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ampline.functions.scalars import no_nan, strip, text_list, to_number

# The trigger names and values that count as valid.
TRIGGER_NAMES = ["IGN_CYL", "CHARGE_STATE", "EV_CHARGE_STATE"]
IGNITION_VALUES = ["ON", "OFF"]
CHARGE_VALUES = ["Active", "Aborted", "Complete", "Completed"]

STATUS = f"lower({strip('IGNITION_STATUS')})"
BATTERY = no_nan("EV_BATTERY_LEVEL")
SPEED = no_nan("SPEED")

# Why a trigger row with a valid time is rejected; NULL for a good one. The rules exclude each other.
TRIGGER_FAULT = f"""case
    when coalesce(NAME not in ({text_list(TRIGGER_NAMES)}), true) then 'name'
    when NAME = 'IGN_CYL' and coalesce(VAL not in ({text_list(IGNITION_VALUES)}), true) then 'ignition'
    when NAME = 'CHARGE_STATE' and ({to_number('VAL')}) is null then 'charge_level'
    when NAME = 'EV_CHARGE_STATE' and coalesce(VAL not in ({text_list(CHARGE_VALUES)}), true) then 'charge_status'
    end"""


def clean_tlm(raw: DataFrame) -> DataFrame:
    """Valid times, normalised status, capped battery and speed, first row of each ID."""
    rows = raw.where("TIMESTAMP is not null").selectExpr(
        "row_ord", "ID", "VEHICLE_ID", "TIMESTAMP",
        f"case when ({SPEED}) < 0 then 0D else {SPEED} end as SPEED",
        f"nullif({STATUS}, 'unknown') as IGNITION_STATUS",
        f"case when ({BATTERY}) > 100 then 100D when ({BATTERY}) >= 0 then {BATTERY} end as EV_BATTERY_LEVEL",
        f"{no_nan('ODOMETER')} as ODOMETER",
        # A rank filter: each map task forwards at most one row of an ID, so a hot ID stays small.
        "row_number() over (partition by ID order by row_ord) as nth",
    )
    return rows.where("nth = 1").drop("nth")


def valid_triggers(raw: DataFrame) -> DataFrame:
    return raw.where(f"CTS is not null and ({TRIGGER_FAULT}) is null")


def clean_trg(raw: DataFrame) -> DataFrame:
    """Valid triggers, one row per (CTS, PNID, NAME, VAL), with its first place in the file."""
    return valid_triggers(raw).groupBy("CTS", "PNID", "NAME", "VAL").agg({"row_ord": "min"}).withColumnRenamed(
        "min(row_ord)", "row_ord"
    )


def clean_syn(raw: DataFrame) -> DataFrame:
    return raw.where("timestamp is not null").selectExpr(
        "row_ord", "vehicleId as vehicle_id", "timestamp as event_ts"
    )

"""Ignition events per source: status changes of a vehicle, and synthetic off events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ampline.config import Params
from ampline.functions.scalars import file_chunk, micros, no_chunk
from ampline.operators.slices import HotCells, in_slice, scan_block, with_context, with_slice
from ampline.staging import stage

EVENT_COLUMNS = ["vehicle_id", "event", "event_ts", "source", "ord1", "ord2"]
SEQUENCE = ("vehicle_id", "source")


def tlm_status(clean: DataFrame) -> DataFrame:
    return clean.where("VEHICLE_ID is not null and IGNITION_STATUS in ('on', 'off')").selectExpr(
        "VEHICLE_ID as vehicle_id", "IGNITION_STATUS as status", "TIMESTAMP as event_ts",
        "'TLM' as source", "0L as ord1", "row_ord as ord2",
    )


def trg_status(mapped: DataFrame) -> DataFrame:
    """Per vehicle, so that several PNIDs of one vehicle interleave."""
    return mapped.where("NAME = 'IGN_CYL' and vehicle_id is not null").selectExpr(
        "vehicle_id", "lower(VAL) as status", "CTS as event_ts",
        "'TRG' as source", "PNID as ord1", "row_ord as ord2",
    )


def ignition_changes(rows: DataFrame, hot: HotCells | None, p: Params) -> DataFrame:
    """Rows whose status differs from the previous one of their (vehicle, source); the first
    always counts.

    ``rows``: vehicle_id, status (on or off), event_ts, source, ord1 (PNID of a trigger, else 0)
    and ord2 (file order); the order is time, ord1, ord2.
    """
    order = ["us", "ord1", "ord2"]
    # Triggers of one instant are few, as exact duplicates are gone: at most ON and OFF per PNID.
    chunk = f"if(source = 'TRG', {no_chunk()}, {file_chunk(rows, 'ord2')})"
    placed = with_slice(rows.selectExpr("*", f"{micros('event_ts')} as us"), chunk, hot, p)
    # Inside a slice the change is final; only the slice's first row still needs its context,
    # and the last row kept here holds the slice's last status.
    local = placed.selectExpr("*", f"lag(status) {in_slice(order, SEQUENCE)} as previous").where(
        "previous is null or previous <> status"
    )
    kept = stage(local, "status-changes")
    seen = with_context(kept, order, before={"carried": "status"}, key=SEQUENCE, block_rows=scan_block(hot, p))
    return seen.where("coalesce(previous, carried, '') <> status").selectExpr(
        "vehicle_id", "if(status = 'on', 'ignitionOn', 'ignitionOff') as event", "event_ts", "source", "ord1", "ord2"
    )


def syn_ignition(clean: DataFrame) -> DataFrame:
    return clean.where("vehicle_id is not null").selectExpr(
        "vehicle_id", "'ignitionOff' as event", "event_ts", "'SYN' as source", "0L as ord1", "row_ord as ord2"
    )

"""Rule parameters, scale parameters and session checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Params:
    # Rules: fixed values, part of the result.
    battery_window_sec: int = 300
    rise_ign_off: float = 2.0
    rise_ign_on: float = 5.0
    min_session_sec: int = 60
    merge_gap_sec: int = 300
    near_dup_gap_sec: int = 10
    null_alert_pct: float = 50.0
    hist_bins: int = 30
    kde_points: int = 200

    # Scale: these change how work is split, never the result.
    slice_sec: int = 3600
    max_slice_rows: int = 2_000_000
    scan_block_rows: int = 200_000
    chain_slices: int = 64
    broadcast_rows: int = 500_000


UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00"}


def require_utc(spark: SparkSession) -> None:
    """All times are naive wall clock; a session zone with jumps would distort differences."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone})")

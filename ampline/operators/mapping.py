"""Vehicle to PNID mapping and the lookup join built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampline.functions.scalars import with_id_list


def parse_map(raw: DataFrame) -> DataFrame:
    """Last row of each vehicle with its parsed list: row_ord, ID, IDS, pnids (NULL where bad)."""
    last = raw.groupBy("ID").agg(F.expr("max(row_ord) as row_ord"), F.expr("max_by(IDS, row_ord) as IDS"))
    return with_id_list(last, "IDS", "pnids").select("row_ord", "ID", "IDS", "pnids")


def claims(parsed: DataFrame) -> DataFrame:
    """One row per list entry: pnid, vehicle_id and its place in map order."""
    return parsed.selectExpr("row_ord", "ID as vehicle_id", "posexplode(pnids) as (pos, pnid)")


def pnid_map(parsed: DataFrame) -> DataFrame:
    """PNID to vehicle; the last claim in map order wins."""
    return claims(parsed).groupBy("pnid").agg(
        F.expr("max_by(vehicle_id, struct(row_ord, pos)) as vehicle_id")
    )


def with_vehicle(trg: DataFrame, pmap: DataFrame) -> DataFrame:
    """Left lookup of the vehicle.

    No hint: at run time AQE broadcasts the map if its measured size is below the broadcast
    threshold, and otherwise splits the partitions of hot PNIDs.
    """
    return trg.join(pmap.withColumnRenamed("pnid", "PNID"), "PNID", "left")

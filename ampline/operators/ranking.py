"""Dense numbering of sorted rows and order statistics, without a window or a buffer that holds all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampline.staging import stage


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``name`` = 0, 1, 2, … in the order of ``order`` (must be unique per row).

    Rows are range partitioned and written with their partition's number, so the ranges stay
    fixed; one count per partition then gives the offsets.
    """
    placed = stage(
        rows.repartitionByRange(*order).withColumn("range_no", F.spark_partition_id()), "numbered"
    )
    # One row per range: bounded by the shuffle partition count.
    sizes = placed.groupBy("range_no").count()
    offsets = sizes.selectExpr(
        "range_no",
        "coalesce(sum(count) over (order by range_no rows between unbounded preceding and 1 preceding), 0) as offset",
    )
    place = f"row_number() over (partition by range_no order by {', '.join(order)})"
    return (
        placed.selectExpr("*", f"{place} as place")
        .join(F.broadcast(offsets), "range_no")
        .selectExpr("*", f"offset + place - 1 as {name}")
        .drop("range_no", "place", "offset")
    )


def quantiles(rows: DataFrame, column: str, shares: list[float]) -> DataFrame:
    """One row with the array ``q``: the values at the ``shares`` of the sorted column, between neighbours in proportion.
    No row where the column has no value.

    Equal values shrink to one row with a count before they are dealt into ranges of values. The ranges' counts tell in
    which of them a wanted rank lies, and only those are searched; no task holds more values than a range.
    """
    counted = rows.selectExpr(f"{column} as v").where("v is not null").groupBy("v").agg(F.expr("count(*) as n"))
    placed = stage(counted.repartitionByRange("v").withColumn("range_no", F.spark_partition_id()), "values")
    # One row per range: bounded by the shuffle partition count.
    ranges = placed.groupBy("range_no").agg(F.expr("sum(n) as held")).selectExpr(
        "range_no", "held", "sum(held) over (order by range_no) - held as before", "sum(held) over () as total"
    )
    at = f"transform(array({', '.join(f'{share}D' for share in shares)}), p -> p * (total - 1))"
    wanted = ranges.selectExpr("*", f"{at} as at").selectExpr(
        "*", "array_distinct(flatten(transform(at, x -> array(cast(floor(x) as bigint), cast(ceil(x) as bigint))))) as ranks"
    ).selectExpr(
        "range_no", "before", "at", "filter(ranks, r -> r >= before and r < before + held) as ranks"
    ).where("size(ranks) > 0")
    found = (
        placed.join(F.broadcast(wanted), "range_no")
        .selectExpr("*", "before + sum(n) over (partition by range_no order by v) - n as first")
        .selectExpr("v", "at", "filter(ranks, r -> r >= first and r < first + n) as ranks")
        .selectExpr("at", "v", "explode(ranks) as r")
    )
    low, high = "values_by_rank[cast(floor(x) as bigint)]", "values_by_rank[cast(ceil(x) as bigint)]"
    return found.groupBy("at").agg(F.expr("map_from_entries(collect_list(struct(r, v))) as values_by_rank")).selectExpr(
        f"transform(at, x -> if(floor(x) = ceil(x), {low}, (ceil(x) - x) * {low} + (x - floor(x)) * {high})) as q"
    )

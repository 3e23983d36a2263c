"""Blocked scans: what the rows before or behind a row hold, without a window over a whole sequence.

A sequence is a key with places in order, one row each. Rows are range partitioned by (key, place) and written with the
number of their range, their block. A window inside (key, block) finds what the block itself holds; one row per key and
block sums the block up, and those rows are scanned in the same way, in ever fewer blocks, until they are few. Then the
blocks' results are pushed down to their rows. No window holds more rows than a block, however long a sequence is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampline.staging import stage

EARLIER = "rows between unbounded preceding and 1 preceding"
LATER = "rows between 1 following and unbounded following"


def _looks(before: dict[str, str], after: dict[str, str], key: str, place: str) -> dict[str, str]:
    """By new column, the last value that is not null of the earlier rows, or the first of the later ones."""
    over = lambda frame: f"over (partition by {key} order by {place} {frame})"
    return {
        **{name: f"last({value}) ignore nulls {over(EARLIER)}" for name, value in before.items()},
        **{name: f"first({value}) ignore nulls {over(LATER)}" for name, value in after.items()},
    }


def scanned(
    rows: DataFrame, key: tuple[str, ...], place: str, before: dict[str, str], after: dict[str, str] | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Add, per new name in ``before``, its column's last value that is not null of the key's earlier rows, and per name in
    ``after`` the first of the later ones.

    ``place`` is unique within a key. Without ``block_rows`` a key's rows are one window; else no window has many more.
    ``rows`` is evaluated several times then, so it should be a written table.
    """
    after = after or {}
    keys = ", ".join(key)
    if block_rows is None or (n := rows.count()) <= block_rows:
        return rows.selectExpr("*", *[f"{look} as {name}" for name, look in _looks(before, after, keys, place).items()])
    blocks = stage(
        rows.repartitionByRange(-(-n // block_rows), *key, place).withColumn("block", F.spark_partition_id()), "scan-blocks"
    )
    sums = blocks.groupBy(*key, "block").agg(
        *[F.expr(f"max_by({value}, if({value} is null, null, {place})) as {name}") for name, value in before.items()],
        *[F.expr(f"min_by({value}, if({value} is null, null, {place})) as {name}") for name, value in after.items()],
    )
    same = lambda names: {f"outer_{name}": name for name in names}
    sums = stage(sums.withColumnRenamed("block", "at"), "scan-sums")
    outer = scanned(sums, key, "at", same(before), same(after), block_rows).withColumnRenamed("at", "block")
    inner = _looks(before, after, f"{keys}, block", place)
    return (
        blocks.selectExpr("*", *[f"{look} as inner_{name}" for name, look in inner.items()])
        .join(outer.drop(*before, *after), [*key, "block"])
        .selectExpr(*rows.columns, *[f"coalesce(inner_{name}, outer_{name}) as {name}" for name in inner])
    )

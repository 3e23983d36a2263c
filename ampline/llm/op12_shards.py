"""Contiguous balanced shards from global prefix sums of byte sizes.

Rows are range partitioned in the given order and written with their range's number. One total per range gives the bytes
and rows before each range, a running sum inside the range the bytes before each row. The line of all bytes is cut at
equal targets: a row belongs to the shard in whose stretch its middle byte lies, so that every shard is a contiguous
stretch of rows and differs from the target by at most the largest row.

SQL expressions only. No range depends on one key: rows of equal order are told apart by their place in the written
table, so a key that a third of the rows share is spread over many ranges. Sizes and checksums are written once, so a
lost executor does not change places and texts are read once.

Defined results: null texts have no bytes; null ids come first; repeated rows are dealt one by one; an empty table
gives no rows; where all sizes are zero, all rows are in shard 0. Copies of a text are dealt like any other rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampline.llm.common import documents, quoted
from ampline.staging import stage

SHARDS = 24
ROW_BYTES = 8  # that a row takes besides its text


def balanced_shards(rows: DataFrame, n_shards: int, order: list[str], size: str = "size") -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, the row's number in its shard; columns of these names are replaced.

    ``size`` names a column of whole numbers, none negative; null counts as 0. All other columns are carried along.
    """
    held = [c for c in rows.columns if c not in ("shard", "slot")]
    bytes_of = F.coalesce(F.col(quoted(size)).cast("bigint"), F.lit(0))
    packed = stage(
        rows.select(F.struct(*map(quoted, held)).alias("row"), bytes_of.alias("bytes")).withColumn(
            "nth", F.monotonically_increasing_id()
        ),
        "shard-rows",
    )
    keys = [*[f"row.{quoted(c)}" for c in order], "nth"]
    ranged = stage(packed.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "shard-ranges")
    # One row per range, so this window and its broadcast are bounded by the number of shuffle partitions.
    earlier = "over (order by part rows between unbounded preceding and 1 preceding)"
    offsets = ranged.groupBy("part").agg(F.sum("bytes").alias("in_part"), F.count("*").alias("n")).selectExpr(
        "part", f"coalesce(sum(in_part) {earlier}, 0L) as bytes_before", f"coalesce(sum(n) {earlier}, 0L) as rows_before",
        "nullif(sum(in_part) over (), 0L) as total",
    )
    inside = f"over (partition by part order by {', '.join(keys)} rows between unbounded preceding and current row)"
    middle = f"2 * (bytes_before + sum(bytes) {inside}) - bytes"  # doubled, so that it is whole
    placed = (
        # By range again: hashes of so few numbers would put several ranges into one task.
        ranged.repartitionByRange("part").join(F.broadcast(offsets), "part")
        .selectExpr(
            "row", f"rows_before + row_number() {inside.split(' rows ')[0]}) as place",
            f"cast(least({n_shards - 1}L, coalesce(({middle}) * {n_shards} div (2 * total), 0L)) as int) as shard",
        )
    )
    placed = stage(placed, "shard-places")
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").selectExpr("row.*", "shard", "place - first as slot")


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, order: list[str] = ["doc_id"]) -> None:  # noqa: B006
    """The whole documents, a folder ``shard=N`` for each shard, sorted by ``slot``."""
    sized = docs.drop("size").withColumn("size", F.expr(f"coalesce(octet_length(text), 0) + {ROW_BYTES}L"))
    sharded = balanced_shards(sized, n_shards, order)
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = documents(spark, sf_dir).selectExpr(
        "doc_id", f"coalesce(octet_length(text), 0) + {ROW_BYTES}L as size",
        "crc32(cast(coalesce(text, '') as binary)) as text_crc32",
    )
    return balanced_shards(sizes, SHARDS, ["doc_id"]).selectExpr(
        "doc_id", "size", "text_crc32", "'bytes' as law", "shard", "slot", "cast(null as int) as grown_shard"
    )

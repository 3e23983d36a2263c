"""Exact deduplication with disk-backed streaming state.

A streaming aggregation keeps one entry per digest in a RocksDB state store that never expires: the number of rows, the
largest document id and the locator (file and row) of the row that has it. Each micro-batch is aggregated by digest
before it is shuffled, so that a text that fills a third of the rows reaches the state as one row per task. State and
progress lie in the shared folder; a lost executor's state is loaded again from there, and a later run over new rows
goes on from it.

A digest that several rows share is a hit. Hits are checked on the full bytes: each row's text is compared with the text
at the entry's locator. Only texts of hits are shuffled for that, as a Bloom filter of their locators, sized by their count,
is asked first. Rows that differ (a collision of digests) are grouped by their whole texts instead.

Texts are equal when they are identical after lower-casing A-Z; null counts as empty. Of equal texts, the row with the
largest document id stays; null ids are the smallest, and of rows with equal ids the one with the largest locator stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampline.llm.common import documents
from ampline.staging import counted, stage, stage_root

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",  # of all partitions of an executor together
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each partition reserves megabytes of disk
}
BATCH_BYTES = str(64 << 30)  # of digest files in a micro-batch
FILTER_BITS = 16  # of the Bloom filter by hit
MOST_FILTER_BITS = 1 << 29  # 64 MB, as it is broadcast; with over 33 million hits it lets more other texts pass, and loses none
ROWS_PER_COPY = 1000  # a checked text is copied once per so many rows of its group


def normalised(text: F.Column) -> F.Column:
    """A-Z lower-cased, all else as it is; ``lower`` does the same to texts of one byte per character, and faster."""
    filled = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(filled) == F.char_length(filled), F.lower(filled)).otherwise(F.translate(filled, UPPER, LOWER))


def sha256(normal: F.Column) -> F.Column:
    return F.sha2(normal, 256)


def located(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` as row (its columns) and locator; frames that don't read files are written to the shared folder first."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")).alias("locator")
    try:
        return docs.select(row, place), False
    except AnalysisException:
        return stage(docs, "content").select(row, place), True


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings for what is run inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def filter_conf(hits: int) -> dict[str, str]:
    """Settings that put a Bloom filter of ``hits`` keys before the exchange of a join."""
    bits = str(min(MOST_FILTER_BITS, max(1 << 16, FILTER_BITS * hits)))
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    return {
        f"{prefix}.enabled": "true", f"{prefix}.applicationSideScanSizeThreshold": "0", f"{prefix}.creationSideThreshold": "1t",
        f"{prefix}.expectedNumItems": str(max(1, hits)), f"{prefix}.maxNumItems": str(max(1, hits)),
        f"{prefix}.numBits": bits, f"{prefix}.maxNumBits": bits,
    }


def update_state(spark: SparkSession, digests: str, schema, checkpoint: str) -> None:
    """Run the stream over all digest files that its checkpoint has not seen."""
    with _settings(spark, STATE_CONF):
        rows = spark.readStream.schema(schema).option("maxBytesPerTrigger", BATCH_BYTES).parquet(digests)
        entries = rows.groupBy("digest").agg(
            F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "locator")).alias("last")
        )
        entries.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start().awaitTermination()


def entries(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state: digest, n, last (largest doc_id and its locator)."""
    state = spark.read.format("statestore").load(checkpoint)
    count, last = state.schema["value"].dataType.names
    return state.select(F.col("key.digest").alias("digest"), F.col(f"value.{count}").alias("n"), F.col(f"value.{last}").alias("last"))


def texts_of(hits: DataFrame, texts: DataFrame) -> DataFrame:
    """``hits`` with ``normal``, their text of ``texts`` (locator, normal); no two rows share a locator."""
    texts = texts.select(F.col("locator").alias("text_at"), "normal")
    return hits.join(texts, hits["locator"] == texts["text_at"]).select(*hits.columns, "normal")


def _checked(texts: DataFrame, hits: DataFrame, n_hits: int) -> DataFrame:
    """Rows of hits with their group's variant: null if their bytes equal those at the entry's locator, else their text.

    The text of an entry goes to its rows in as many copies as the group's size needs, so that no task gets one large group.
    """
    with _settings(hits.sparkSession, filter_conf(n_hits)):
        rows = stage(texts_of(hits.select("digest", "doc_id", "locator", "n", "last"), texts), "hits")
    copies = F.ceil(F.col("n") / ROWS_PER_COPY).cast("int")
    first = rows.where(F.col("locator") == F.col("last.locator")).select(
        F.col("digest").alias("of"), F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"), F.col("normal").alias("stored")
    )
    dealt = rows.withColumn("dealt", F.pmod(F.xxhash64("locator"), copies).cast("int"))
    same = dealt.join(first, (F.col("digest") == F.col("of")) & (F.col("dealt") == F.col("copy")))
    return same.select(
        "digest", "doc_id", "locator", F.when(F.col("normal") != F.col("stored"), F.col("normal")).alias("variant")
    )


def duplicates(rows: DataFrame, digest=sha256) -> DataFrame:
    """``rows`` as from ``located``, with doc_id and text inside ``row``: doc_id, locator, keep_id, keep_at, group_size, digest."""
    spark = rows.sparkSession
    normal = normalised(F.col("row.text"))
    keyed = rows.select(F.col("row.doc_id").alias("doc_id"), "locator", digest(normal).alias("digest"))
    folder = f"{stage_root(spark)}/ampline/dedup-{uuid.uuid4().hex}"
    keyed.write.parquet(f"{folder}/digests")
    update_state(spark, f"{folder}/digests", keyed.schema, f"{folder}/state")
    members = spark.read.schema(keyed.schema).parquet(f"{folder}/digests").join(entries(spark, f"{folder}/state"), "digest")
    members, figures = counted(members, "members", {"hits": "count_if(n > 1)"})
    alone = members.where("n = 1").select(
        "doc_id", "locator", F.col("doc_id").alias("keep_id"), F.col("locator").alias("keep_at"), F.lit(1).cast("bigint").alias("group_size"), "digest"
    )
    hits = stage(_checked(rows.select("locator", normal.alias("normal")), members.where("n > 1"), figures["hits"] or 0), "checked")
    groups = hits.groupBy("digest", "variant").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "locator")).alias("last")
    ).select(F.col("digest").alias("of"), F.col("variant").alias("its"), "group_size", "last")
    grouped = hits.join(groups, (F.col("digest") == F.col("of")) & F.col("variant").eqNullSafe(F.col("its"))).select(
        "doc_id", "locator", F.col("last.doc_id").alias("keep_id"), F.col("last.locator").alias("keep_at"), "group_size", "digest"
    )
    return alone.unionByName(grouped)


def keep_one(docs: DataFrame, digest=sha256) -> DataFrame:
    """``docs`` without all but one row of each group of equal texts, with all their columns."""
    rows, _ = located(docs)
    dropped = duplicates(rows, digest).where(F.col("locator") != F.col("keep_at")).select(F.col("locator").alias("gone"))
    return rows.join(dropped, rows["locator"] == dropped["gone"], "left_anti").select("row.*")


def op9_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = duplicates(located(documents(spark, sf_dir).select("doc_id", "text"))[0])
    kept = (F.col("locator") == F.col("keep_at")).alias("kept")
    return found.select("doc_id", "keep_id", "group_size", kept, F.col("digest").alias("text_sha256"))


ORACLE_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS normal FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(normal) AS text_sha256
FROM t WINDOW g AS (PARTITION BY normal)
"""

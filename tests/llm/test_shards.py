"""Contiguous shards against prefix sums in plain Python."""

import random
import zlib

from pyspark.sql import functions as F

from ampline.llm.op12_shards import balanced_shards, op12_shards, write_shards
from tests.llm.data import SMALL, frame, odd_docs


def brute(sizes, n):
    """(shard, slot) of rows in order."""
    total, before, counts, out = sum(sizes), 0, [0] * n, []
    for size in sizes:
        shard = min(n - 1, (2 * before + size) * n // (2 * total)) if total else 0
        out.append((shard, counts[shard]))
        counts[shard] += 1
        before += size
    return out


def test_query_equals_brute_force(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    data = [(r.text or "").encode() for r in docs]
    placed = brute([len(t) + 8 for t in data], 24)
    want = [(r.doc_id, len(t) + 8, zlib.crc32(t), "bytes", *p, None) for r, t, p in zip(docs, data, placed)]
    assert sorted(map(tuple, op12_shards(spark, SMALL).collect())) == want


def test_every_shard_is_near_its_target(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([0, 1, 5, 300])) for i in range(5000)]
    got = balanced_shards(spark.createDataFrame(rows, "doc_id bigint, size int"), 7, ["doc_id"])
    assert [(r.shard, r.slot) for r in got.orderBy("doc_id").collect()] == brute([s for _, s in rows], 7)
    sums = [r[0] for r in got.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(sums) == 7 and max(abs(s - sum(x for _, x in rows) / 7) for s in sums) <= 300


def test_one_key_on_a_third_of_the_rows_is_spread(spark):
    """No range of rows hangs on one key, and its rows get different slots."""
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 5, id) as doc_id", "10 as size")
    got = balanced_shards(rows, 10, ["doc_id"])
    assert [tuple(r) for r in got.groupBy("shard").agg(F.count("*"), F.min("slot"), F.max("slot"), F.countDistinct("slot")).orderBy("shard").collect()] == [
        (s, 3000, 0, 2999, 3000) for s in range(10)
    ]


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumn("size", F.lit(None).cast("int")).withColumn("shard", F.lit("x"))
    got = balanced_shards(docs, 3, ["doc_id"])
    assert got.count() == docs.count() and {r.shard for r in got.collect()} == {0}
    assert set(got.columns) == {*docs.columns, "slot"}
    negative = frame(spark, [(None, "a"), (None, None), (-5, "b"), (3, "")]).selectExpr("*", "1 as size")
    assert [r.doc_id for r in balanced_shards(negative, 4, ["doc_id"]).orderBy("shard").collect()] == [None, None, -5, 3]
    assert balanced_shards(docs.limit(0), 3, ["doc_id"]).collect() == []


def test_written_shards_hold_whole_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    write_shards(docs, f"{tmp_path}/shards", 5)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(map(str, back.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    ends = back.groupBy("shard").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).orderBy("shard").collect()
    assert len(ends) == 5 and all(a.high < b.low for a, b in zip(ends, ends[1:]))


def test_main_path_stays_in_the_jvm(spark, capsys):
    op12_shards(spark, SMALL).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan

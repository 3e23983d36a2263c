"""Exact and near duplicates and repeated passages against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ampline.llm import op3_repeats, op8_simhash, op9_dedup
from ampline.llm.common import documents
from ampline.llm.run_index import matching_statistics, suffix_array
from ampline.llm.windows import GRAM, WINDOW, Hashes, find_runs
from ampline.staging import stage
from tests.compare import differences, oracle_rows, spark_rows
from tests.llm.data import ROWS, SMALL, frame, odd_docs, texts_of


# ---- exact ----


def test_exact_query_equals_sql(spark):
    assert differences(spark_rows(op9_dedup.op9_dedup(spark, SMALL)), oracle_rows(SMALL, op9_dedup.ORACLE_SQL)) == ""


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("digits", [64, 1])  # whole digests, and ones that collide
def test_exact_keeps_the_largest_id(spark, digits):
    docs = odd_docs(spark)
    rows = docs.select("doc_id", "text").collect()
    kept = op9_dedup.keep_one(docs, lambda normal: F.substring(F.sha2(normal, 256), 1, digits))
    largest = {}
    for r in rows:
        key = lowered(r.text)
        largest[key] = max(largest.get(key, -1), -1 if r.doc_id is None else r.doc_id)
    assert kept.columns == docs.columns
    assert Counter((-1 if r.doc_id is None else r.doc_id, lowered(r.text)) for r in kept.collect()) == Counter(
        (i, t) for t, i in largest.items()
    )


def test_exact_of_no_rows(spark):
    assert op9_dedup.keep_one(odd_docs(spark).where("false")).count() == 0


def test_exact_copies_of_one_text_are_checked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(op9_dedup, "ROWS_PER_COPY", 3)
    rows = frame(spark, [(i, "Same Text" if i % 2 else "same text") for i in range(50)] + [(50, "other")])
    found = op9_dedup.duplicates(op9_dedup.located(rows)[0]).collect()
    assert Counter((r.keep_id, r.group_size) for r in found) == {(49, 50): 50, (50, 1): 1}


def test_only_texts_of_hits_are_shuffled(spark):
    """A Bloom filter stands before the exchange of texts and lets all texts of hits pass; the session keeps its settings."""
    size = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(size)
    rows = op9_dedup.located(documents(spark, SMALL).select("doc_id", "text"))[0]
    keyed = rows.select("locator", F.col("row.doc_id").alias("doc_id"), F.when(F.col("row.doc_id") % 10 == 0, 2).otherwise(1).alias("n"))
    hits = stage(keyed, "members").where("n > 1")
    want = hits.count()
    conf = op9_dedup.filter_conf(want) | {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    with op9_dedup._settings(spark, conf):
        found = op9_dedup.texts_of(hits, rows.select("locator", op9_dedup.normalised(F.col("row.text")).alias("normal")))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == want
    assert "might_contain" in plan
    assert spark.conf.get(size) == before


def test_state_goes_on_from_earlier_rows(spark, tmp_path):
    """A later run over new files sees the entries of the first one."""
    schema = "doc_id bigint, locator struct<file:string,at:bigint>, digest string"
    frame_of = lambda ids: spark.createDataFrame([(i, ("f", i), "d") for i in ids], schema)
    folder, state = f"{tmp_path}/digests", f"{tmp_path}/state"
    for ids in ([1, 5], [3]):
        frame_of(ids).write.mode("append").parquet(folder)
        op9_dedup.update_state(spark, folder, frame_of([]).schema, state)
    row = op9_dedup.entries(spark, state).first()
    assert (row.digest, row.n, row["last"].doc_id) == ("d", 3, 5)


# ---- near ----


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, distance=4):
    fps, parent = np.array(fps, np.uint64), list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= distance):
            parent[root(int(j))] = root(i)
    least = {}
    for i in range(len(fps)):
        least[root(i)] = min(least.get(root(i), 1 << 62), ids[i])
    return [least[root(i)] for i in range(len(fps))]


def test_near_query(spark):
    rows = documents(spark, SMALL).select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    ids = [r.doc_id for r in rows]
    want = {i: (f"{f:016x}", c) for i, f, c in zip(ids, fps, plain_components(ids, fps))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in op8_simhash.op8_simhash(spark, SMALL).collect()} == want


def clusters():
    rng = np.random.default_rng(0)
    points = {int(x) for x in rng.integers(0, 1 << 63, 100)}
    for x in sorted(points)[:50]:
        y = x
        for _ in range(int(rng.integers(1, 30))):
            for b in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                y ^= 1 << int(b)
            points.add(y)
            y = y if rng.random() < 0.5 else x
    return sorted(points)


@pytest.mark.parametrize(("crowd", "small"), [(20_000, 64), (20_000, 2), (4, 64)])
def test_near_links_by_cells_blocks_and_midpoints(spark, monkeypatch, crowd, small):
    monkeypatch.setattr(op8_simhash, "CELL_POINTS", crowd)
    monkeypatch.setattr(op8_simhash, "SMALL_CELL", small)
    points = clusters()
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    rows = spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fp bigint")
    got = {r.fp: r.component_id for r in op8_simhash.classes(rows).collect()}
    assert [got[x] for x in signed] == plain_components(range(len(points)), points)


def test_segment_counts_bound_the_distance():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 63, (2, 1000)).astype(np.uint64)
    manhattan = np.abs(op8_simhash.embed(a).astype(int) - op8_simhash.embed(b).astype(int)).sum(axis=1)
    assert (manhattan <= np.bitwise_count(a ^ b)).all()
    assert [h - low for low, h in op8_simhash.axis_groups(4)] == [4] * 8


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 200), (300, 301)], "a bigint, b bigint")
    got = {r.node: r.root for r in op8_simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(101)} | {300: 300, 301: 300}


def test_near_of_odd_rows(spark):
    docs = odd_docs(spark)
    kept = op8_simhash.keep_one(docs)
    fps = {}
    for i, text, _ in ROWS:
        fps.setdefault(plain_fingerprint(text), []).append(i)
    wordless = next(r for r in kept.collect() if not (r.text or "").strip())
    assert wordless.doc_id == 2 and kept.columns == docs.columns
    assert kept.count() == len(set(plain_components(range(len(fps)), list(fps))))
    assert op8_simhash.keep_one(docs.where("false")).count() == 0


# ---- repeats ----


def plain_removal(texts):
    texts = [(t or "").encode() for t in texts]
    often = Counter(t[i : i + WINDOW] for t in texts for i in range(len(t) - WINDOW + 1))
    out = []
    for t in texts:
        edges = np.zeros(len(t) + 1, int)
        for i in range(len(t) - WINDOW + 1):
            if often[t[i : i + WINDOW]] > 1:
                edges[i] += 1
                edges[i + WINDOW] -= 1
        gone = np.cumsum(edges[:-1]) > 0
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def passages():
    base = [t for _, t in texts_of("abcdefgh é", 12, 900, 5)]
    rows = []
    for i in range(200):
        rng = np.random.default_rng(i)
        text = ""
        for _ in range(int(rng.integers(0, 5))):
            part = base[int(rng.integers(0, 12))]
            text += part[int(rng.integers(0, len(part) + 1)) :]
            if rng.random() < 0.3:
                text += "x" * int(rng.integers(0, 500))
            text += "".join(rng.choice(list("abcdefgh"), int(rng.integers(0, 300))))
        rows.append((i, text if i else None))
    return rows


@pytest.mark.parametrize("size", [300, 1000, 1 << 21])
def test_blocks_hold_each_window_once(monkeypatch, size):
    monkeypatch.setattr(op3_repeats, "BLOCK_BYTES", size)
    texts = ["".join(np.random.default_rng(n).choice(list("abcdé "), n)) for n in (0, 5, 199, 200, 201, 1000, 5000)]
    seen = Counter()
    for row, start, data, bounds in op3_repeats._blocks(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])):
        runs = find_runs(data, bounds, Hashes(data))
        owner = np.searchsorted(bounds, runs.first, "right") - 1
        for first, last, k in zip(runs.first, runs.last, owner):
            seen.update((row[k], p - bounds[k] + start[k]) for p in range(first, last + 1))
    assert set(seen.values()) == {1}
    assert len(seen) == sum(max(0, len(t.encode()) - WINDOW + 1) for t in texts)


@pytest.mark.parametrize(("crowd", "bits", "part"), [(4000, 64, 1000), (1, 64, 1000), (4000, 2, 1000), (10, 1, 3), (4000, 64, 1)])
def test_repeats_equal_brute_force(spark, monkeypatch, crowd, bits, part):
    """Also where k-grams' hashes collide, and where rows of most keys are dealt into parts."""
    monkeypatch.setattr(op3_repeats, "CROWD", crowd)
    monkeypatch.setattr(op3_repeats, "GRAM_BITS", bits)
    monkeypatch.setattr(op3_repeats, "PART_ROWS", part)
    rows = passages()
    got = op3_repeats.removal(frame(spark, rows), digest=True)
    got = got.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").cast("string")).collect()
    assert sorted(map(tuple, got)) == sorted((i, *w) for (i, _), w in zip(rows, plain_removal([t for _, t in rows])))


def test_repeats_query(spark):
    rows = documents(spark, SMALL).select("doc_id", "text").collect()
    want = sorted((r.doc_id, *w) for r, w in zip(rows, plain_removal([r.text for r in rows])))
    assert sorted(map(tuple, op3_repeats.op3_repeats(spark, SMALL).collect())) == want


def test_repeats_of_odd_rows(spark):
    docs = odd_docs(spark)
    got = op3_repeats.removal(docs).collect()
    want = plain_removal([t for _, t, _ in ROWS])
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got) == Counter(want)
    assert list(got[0].row.asDict()) == docs.columns
    assert op3_repeats.removal(docs.where("false")).count() == 0
    assert GRAM < WINDOW


def test_hot_keys_are_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(op3_repeats, "PART_ROWS", 10)
    rows = spark.range(5000).selectExpr("id as file", "0 as at", "0 as first", "if(id < 4000, 7, id) as gram")
    keys = spark.createDataFrame([(7, 4000, True), (4500, 1, False)], "gram bigint, n bigint, alike boolean")
    found = op3_repeats.joined(rows, keys, ["gram"], ["file", "at", "first"], 4001)
    assert found.columns == ["file", "at", "first", "gram", "alike"]
    assert Counter((r.gram, r.alike) for r in found.collect()) == {(7, True): 4000, (4500, False): 1}
    assert found.select("file").distinct().count() == 4001


def test_index_equals_plain_search():
    for i, text in texts_of("ab", 150, 50, 7) + texts_of("abcd", 100, 60, 8):
        data = text.encode() * (1 + i % 3)
        array = np.frombuffer(data, np.uint8)
        if len(data):
            assert suffix_array(array)[0].tolist() == sorted(range(len(data)), key=lambda k: data[k:])
        want = [
            max((next((k for k in range(len(data)) if max(a, b) + k >= len(data) or data[a + k] != data[b + k])) for b in range(len(data)) if b != a), default=0)
            for a in range(len(data))
        ]
        assert matching_statistics(array).tolist() == want

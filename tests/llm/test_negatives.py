"""Hard negatives against a search of all rows for each positive."""

import math
import random

import numpy as np
import pytest

from ampline.llm import op13_negatives as op
from tests.compare import differences, oracle_rows, spark_rows
from tests.llm.data import SMALL

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows):
    held = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        held.append((vec_id, [math.floor(256 * x) for x in vector], label))
    last = lambda i: (i is None, i)
    out = []
    for k, (anchor, a, label) in enumerate(held):
        if anchor is None or anchor % 50:
            continue
        ranked = sorted(
            ((sum(x * y for x, y in zip(a, v)), i, other) for j, (i, v, other) in enumerate(held) if j != k),
            key=lambda r: (-r[0], last(r[1])),
        )
        for s, positive, _ in [r for r in ranked if r[2] == label][:5]:
            fits = [r for r in ranked if r[2] != label and 50 * s <= 100 * r[0] <= 95 * s]
            out += [(anchor, positive, n + 1, i, s, t) for n, (t, i, _) in enumerate(fits[:3])]
    return out


def mined(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as nth", "2 as anchor", "3 as part", "4 as block")
    return [tuple(r) for r in op.hard_negatives(op.whole_vectors(docs), "id % 50 = 0").collect()]


def near(rng, dims, labels, n):
    """Vectors that point much the same way, with many equal scores."""
    base = [rng.choice([0.25, 0.5]) for _ in range(dims)]
    return [(i, [b + rng.choice([-0.25, 0.0, 0.0, 0.125]) for b in base], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("labels,seed", [(2, 1), (10, 2), (1, 3)])
def test_equals_brute_force(spark, monkeypatch, labels, seed):
    monkeypatch.setattr(op, "CHUNK_ROWS", 60)
    monkeypatch.setattr(op, "BLOCK_ANCHORS", 3)
    monkeypatch.setattr(op, "PART_CHUNKS", 2)
    rows = near(random.Random(seed), 6, labels, 400)
    want = brute(rows)
    assert sorted(mined(spark, rows)) == sorted(want)
    assert want or labels == 1


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = near(rng, 4, 2, 110)
    inf, nan = float("inf"), float("nan")
    rows += [(100, [0.5] * 4, None), (150, None, 1), (200, [0.5, None, 0.5, 0.5], 1), (250, [0.5, inf, 0.5, 0.5], 0), (300, [nan] * 4, 0)]
    rows += [(50, *rows[50][1:]), (50, *rows[50][1:]), (51, *rows[51][1:])]  # repeated anchors and rows
    rows += [(None, [0.5] * 4, 0), (None, [0.5] * 4, 1), (350, [], 0), (400, [0.5, 0.5], 1), (-50, [-0.5, 0.5, 0.5, 0.25], -3)]
    assert sorted(map(str, mined(spark, rows))) == sorted(map(str, brute(rows)))
    assert mined(spark, [(50, [1.0], 1)]) == [] and mined(spark, []) == []


def test_negative_and_zero_scores(spark):
    rows = [(0, [1.0, 0.0], 1)] + [(i, [x, 0.5], i % 2) for i, x in enumerate((-0.5, -0.25, 0.0, 0.0, 0.25, 0.5, -0.125, 0.125), 1)]
    assert sorted(mined(spark, rows)) == sorted(brute(rows))


def test_large_components_stay_exact(spark):
    rng = random.Random(9)
    for scale in (2.0**6, 2.0**14, 2.0**20):
        rows = [(i, [scale * (1 + rng.random()) for _ in range(5)], i % 3) for i in range(120)]
        assert sorted(mined(spark, rows)) == sorted(brute(rows))


def test_products_choose_an_exact_kind():
    rng = np.random.default_rng(1)
    for top, kind in ((200, np.float32), (1 << 20, np.float64), (1 << 29, np.int64)):
        a, b = rng.integers(-top, top, (9, 16)), rng.integers(-top, top, (7, 16))
        got = op.products(a, b)
        assert got.dtype == kind and (got.astype(np.int64) == a @ b.T).all()


@pytest.mark.parametrize("seed", range(5))
def test_best_equals_sorting(seed):
    rng = np.random.default_rng(seed)
    best, seen = op.Best(4, 3), []
    for _ in range(6):
        lists, scores, ids = rng.integers(0, 4, 20), rng.integers(0, 9, 20), rng.integers(0, 50, 20)
        best.add(lists, scores, ids, ids)
        seen += zip(lists.tolist(), (-scores).tolist(), ids.tolist())
    want = [x for k in range(4) for x in sorted(s for s in seen if s[0] == k)[:3]]
    assert list(zip(best.list.tolist(), (-best.score).tolist(), best.id.tolist())) == want


def test_query_equals_sql(spark):
    got = spark_rows(op.op13_negatives(spark, SMALL))
    assert differences(got, oracle_rows(SMALL, op.ORACLE_SQL)) == "" and got[1]

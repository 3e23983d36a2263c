"""Periodic runs against a search of all periods and starts."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from ampline.llm.op11_runs import collapse_runs, find_runs, op11_runs
from tests.llm.data import CLASHING, SMALL, frame, odd_docs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """(start, length, period) of all runs, period by period, without windows or numbers."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, WORDS.findall(text or ""))
    runs, dropped = brute(words), set()
    for start, length, period in runs:
        dropped.update(range(start + period, start + length))
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *figures, sha(lines), sha(kept))


def periodic(rng, alphabet):
    out = []
    for _ in range(rng.randint(1, 4)):
        out += [rng.randrange(alphabet) for _ in range(rng.randint(0, 9))]
        block = [rng.randrange(alphabet) for _ in range(rng.randint(1, 40))]
        times = rng.choice([1, 2, 3, 4, 4, 5, 9])
        out += (block * times)[: max(1, len(block) * times - rng.randint(-1, 3))]
    return out


@pytest.mark.parametrize("alphabet", [1, 2, 3, 50])
def test_runs_of_many_texts_at_once(alphabet):
    rng = random.Random(alphabet)
    texts = [periodic(rng, alphabet) for _ in range(300)] + [[]]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    rows = find_runs(np.array(sum(texts, []), np.int64), bounds)
    want = [(i, *run) for i, text in enumerate(texts) for run in brute(text)]
    assert [tuple(r) for r in rows.tolist()] == want and want


def test_long_periods_and_nested_runs():
    rng = random.Random(5)
    inner = [rng.randrange(9) for _ in range(30)] * 5
    outer = (inner + [rng.randrange(9) for _ in range(901)]) * 4
    assert [tuple(r[1:]) for r in find_runs(np.array(outer), np.array([0, len(outer)])).tolist()] == brute(outer)


def test_a_text_of_one_word_and_a_long_one():
    same = np.zeros(400_000, np.int64)
    assert find_runs(same, np.array([0, len(same)])).tolist() == [[0, 0, 400_000, 1]]
    rng = np.random.default_rng(3)
    block = rng.integers(0, 20_000, 70_000)
    text = np.concatenate((rng.integers(0, 20_000, 50_000), np.tile(block, 4)))
    (row,) = find_runs(text, np.array([0, len(text)])).tolist()
    assert row[2:] == [280_000, 70_000] and row[1] == 50_000


def test_no_fewer_than_four_periods():
    with pytest.raises(ValueError):
        find_runs(np.zeros(9, np.int64), np.array([0, 9]), least_exponent=3)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [r for r in rows if len(r.text or "") < 30_000 or zlib.crc32(str(r.doc_id).encode()) % 10]
    want = sorted(map(str, (expected(r.doc_id, r.text) for r in rows)))
    ids = {r.doc_id for r in rows}
    got = [tuple(r) for r in op11_runs(spark, SMALL).collect()]
    assert len(got) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert sorted(str(r) for r in got if r[0] in ids) == want
    assert any(r[1] for r in got)


def test_planted_rows_of_every_length(spark, tmp_path):
    rng = random.Random(8)
    odd = ["", " ", None, "x", "a b\tc\n\x0bd  e", "é \U0001f600 a b", "w " * 5]
    rows = [(i, rng.choice(odd) if i % 3 else " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 120)))) for i in range(-50, 900)]
    rows += [(None, "a b c d e f g h"), (None, None), (7, "x y " * 9), (7, "x y " * 9)]
    path = str(tmp_path)
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    got = sorted(str(tuple(r)) for r in op11_runs(spark, path).collect())
    assert got == sorted(str(expected(*r)) for r in rows)


def test_odd_rows_and_empty_table(spark):
    docs = odd_docs(spark)
    names = [c for c in CLASHING if c != "n_words"]
    got = collapse_runs(docs, ["doc_id", *names]).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    assert (by_id[4].n_words, by_id[4].runs, by_id[4].collapsed) == (0, [], "")
    assert [tuple(x) for x in by_id[5].runs] == [(0, 18_000, 6)] and by_id[5].collapsed == "lorem ipsum dolor sit amet consectetur"
    assert collapse_runs(docs.limit(0), ["doc_id"]).collect() == []

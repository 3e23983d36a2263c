"""More labels than one block of languages, and languages with one text."""

import random
import zlib

import numpy as np

from ampline.llm import op6_language

SCHEMA = "doc_id bigint, text string, lang string"


def learnt(i):
    return zlib.crc32(str(i).encode()) % 4 != 2


def own_words(lang, n, seed):
    rng = random.Random(f"{lang}-{seed}")
    letters = [chr(0x4E00 + 7 * lang + k) for k in range(7)]
    return " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(n))


def test_all_labels_are_learnt(spark):
    ids = [i for i in range(2000) if learnt(i)]
    rows = [(i, own_words(k, 30, i), f"l{k:03}") for k, i in enumerate(ids[:230])]
    docs = spark.createDataFrame(rows + [(9000, "...", None), (9000, "...", None)], SCHEMA)
    got = op6_language.predict(docs, op6_language.train(op6_language.training_sample(docs))).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in got) == sorted([(i, lang) for i, _, lang in rows] + [(9000, "und")] * 2)
    assert all(0 <= r.score <= 1 for r in got)


def test_blocks_change_nothing(spark, monkeypatch):
    ids = [i for i in range(200) if learnt(i)][:40]
    rows = [(i, "".join(random.Random(i).choice("abc de") for _ in range(60)), f"l{k % 7}") for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, SCHEMA)

    def run():
        return sorted(map(tuple, op6_language.predict(docs, op6_language.train(op6_language.training_sample(docs))).collect()))

    whole = run()
    monkeypatch.setattr(op6_language, "BLOCK_BYTES", 20_000)  # about two languages
    assert [r[:2] for r in run()] == [r[:2] for r in whole] and np.allclose([r[2] for r in run()], [r[2] for r in whole])


def test_a_single_long_text_is_learnt_as_a_whole(spark):
    i, j = [i for i in range(20) if learnt(i)][:2]
    text = own_words(1, 8000, 0)
    docs = spark.createDataFrame([(i, text, "long"), (j, own_words(2, 50, 0), "short")], SCHEMA)
    model = op6_language.train(op6_language.training_sample(docs)).model(0)
    automaton = model.automata[model.languages.index("long")]
    assert round(2**automaton.phrase_bits) == 5 * len(set(text.split()))


def test_many_rows_of_one_id_give_a_bounded_sample(spark):
    """Rows without an id, or with one and the same, are chosen by their place."""
    rows = [(None, f"text number {i} of many", "en") for i in range(5000)] + [(3, "the same text", "de")] * 3000
    docs = spark.createDataFrame(rows, SCHEMA)
    counts = {r.lang: r["count"] for r in op6_language.training_sample(docs).groupBy("lang").count().collect()}
    assert 0 < counts["en"] <= op6_language.TRAIN_TEXTS and counts.get("de", 0) <= op6_language.TRAIN_TEXTS


def test_und_can_be_a_label(spark):
    i, j = [i for i in range(20) if learnt(i)][:2]
    docs = spark.createDataFrame([(i, own_words(1, 50, 0), "und"), (j, own_words(2, 50, 0), "xx"), (99, "...", None)], SCHEMA)
    got = {r.doc_id: r for r in op6_language.predict(docs, op6_language.train(op6_language.training_sample(docs))).collect()}
    assert (got[i].lang_pred, got[99].lang_pred) == ("und", "und") and got[i].score > 0 and got[99].score == 0


def phrases(word, text):
    """Longest matches, one after the other."""
    n, at = 0, 0
    while at < len(word):
        size = 0
        while at + size < len(word) and word[at : at + size + 1] in text:
            size += 1
        n, at = n + 1, at + max(1, size)
    return n


def test_query_equals_plain_cross_parsing(spark):
    """Predictions and scores from the learnt texts by substring search."""
    from tests.llm.data import SMALL

    docs = op6_language.documents(spark, SMALL).select("doc_id", "text", "lang")
    sample = op6_language.training_sample(docs).collect()
    texts, sizes = {}, {r.lang: r.n for r in sample}
    for lang in sizes:
        rows = [r for r in sample if r.lang == lang]
        share = op6_language.SAMPLE_CHARS // min(len({r.text for r in rows}), op6_language.SHARES)
        cut = sorted({(r.text[:share]): (r.place, r.text[:share]) for r in sorted(rows, key=lambda r: -r.place)}.values())
        texts[lang] = op6_language.learnt_text([t for _, t in cut])
    order = sorted(texts, key=lambda lang: (-sizes[lang], lang))
    memo = {}
    for row in op6_language.op6_language(spark, SMALL).join(docs, "doc_id").collect():
        if len(row.text or "") > 8000:
            continue
        words = [w for w in "".join(c if c.isspace() else c for c in (row.text or "")).split() if w]
        bare = ["".join(c for c in w.lower() if c.isalpha()) for w in words]
        costs = []
        for lang in order:
            n = 0
            for w in filter(None, bare):
                if (lang, w) not in memo:
                    memo[lang, w] = phrases(w, texts[lang])
                n += memo[lang, w]
            costs.append(n * np.log2(max(2, len(texts[lang]))))
        if not any(bare):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        best = int(np.argmin(costs))
        assert row.lang_pred == order[best]
        assert abs(row.score - max(0, 1 - costs[best] / max(1e-9, sorted(costs)[1]))) < 1e-9

"""BPE, token files and quality rules against the tokenizers themselves and plain counts."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ampline.llm import op2_bpe, op5_pfor, op10_quality
from ampline.llm.common import documents
from ampline.llm.tokenizer import public_path
from ampline.llm.transducer import Transducer, compile_words
from tests.llm.data import ROWS, SMALL, frame, odd_docs, texts_of

BYTES, WORDS, PIECES = (public_path(n) for n in (op2_bpe.TOKENIZER, op5_pfor.TOKENIZER, op10_quality.TOKENIZER))
SPACED = ["a", "b", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", " ", "　", "1", "'s", "é", "!", "<|endoftext|>"]


def bag(rows):
    return sorted(map(repr, rows))


def encoded(tokenizer, rows):
    out = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        out.append((doc_id, len(ids), ",".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False)))
    return bag(out)


def test_transducer_numbers_its_words():
    words = sorted({w for w in b"a ab abc b bc c ca cab cabs tab tabs".split()})
    t = Transducer(compile_words(words, [[i, i + 1] for i in range(len(words))]))
    looked = pa.array([*words, b"", b"abcd", b"t", b"x"], pa.binary())
    assert t.ranks(looked).tolist() == [*range(len(words)), -1, -1, -1, -1]
    assert t.ids[t.bounds[3] : t.bounds[4]].tolist() == [3, 4]


def test_bpe_equals_the_library(spark):
    rows = [(i, t) for i, t, _ in ROWS] + texts_of(SPACED, 300, 30, 1)
    tokenizer = Tokenizer.from_file(BYTES)
    for most in (5, 1000):  # nearly all pieces unseen, and most of them in the lexicon
        got = op2_bpe.encode_decode(frame(spark, rows), BYTES, ["doc_id"], most)
        assert bag(map(tuple, got.collect())) == encoded(tokenizer, rows)


def test_bpe_query_and_edges(spark):
    rows = [tuple(r) for r in documents(spark, SMALL).select("doc_id", "text").collect()]
    want = [(i, n, *(hashlib.sha256(x.encode()).hexdigest() for x in (ids, text))) for i, n, ids, text in map(eval, encoded(Tokenizer.from_file(BYTES), rows))]
    assert bag(map(tuple, op2_bpe.op2_bpe(spark, SMALL).collect())) == bag(want)
    odd = op2_bpe.digests(odd_docs(spark), BYTES, ["doc_id", "n_words"])
    assert odd.columns[:3] == ["doc_id", "n_words", "n_tokens"] and odd.count() == len(ROWS)
    assert op2_bpe.digests(odd_docs(spark).where("false"), BYTES, ["doc_id"]).count() == 0


@pytest.mark.parametrize("n", [0, 1, 63, 1024, 1025, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    for top in (1, 2, 300, 50_000, 2**32 - 1):
        ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
        if n:
            ids[n // 2] = 2**32 - 1
        starts, payload = op5_pfor.pack_ids(ids)
        assert (op5_pfor.unpack_ids(starts, payload) == ids).all()
        assert (op5_pfor.unpack_ids(starts[1:], payload) == ids[op5_pfor.BLOCK_IDS :]).all()


def token_rows(rows):
    tokenizer, out, start = Tokenizer.from_file(WORDS), [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, op5_pfor.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files(spark):
    rows = sorted(tuple(r) for r in documents(spark, SMALL).select("doc_id", "text").collect())
    assert bag(map(tuple, op5_pfor.op5_pfor(spark, SMALL).collect())) == bag(token_rows(rows))
    odd = texts_of([*SPACED, "İ", "Σ", "é", "I'M"], 300, 30, 2)
    got = op5_pfor.read_documents(op5_pfor.segments(frame(spark, odd), WORDS))
    assert bag(map(tuple, got.collect())) == bag(token_rows(odd))


def test_token_files_of_odd_rows(spark):
    got = op5_pfor.read_documents(op5_pfor.segments(odd_docs(spark), WORDS)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in ROWS)
    spans = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert op5_pfor.read_documents(op5_pfor.segments(odd_docs(spark).where("false"), WORDS)).count() == 0


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_counts():
    texts = [t or "" for _, t, _ in ROWS] + [t for _, t in texts_of(["a", "b", " ", " ", "\n", "#", "\x0c", "é"], 500, 60, 3)]
    got = op10_quality.measure(pa.array(texts), PIECES)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, text in enumerate(texts):
        assert tuple(int(got[n][i]) for n in names) == plain_counts(text)


def test_fertility_by_hand():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    text = "the cat the 𝒳 dog, ***"
    ids = [i for w in text.split() for i in model.encode(w)]
    got = op10_quality.measure(pa.array([text]), PIECES)
    counts = np.array(list(Counter(ids).values()))
    share = counts / len(ids)
    assert got["n_tokens"][0] == len(ids)
    assert got["byte_share"][0] == pytest.approx(sum(model.is_byte(i) for i in ids) / len(ids))
    assert got["chars_per_token"][0] == pytest.approx(len("thecatthe𝒳dog") / len(ids))
    assert got["token_entropy"][0] == pytest.approx(-(share * np.log2(share)).sum() / np.log2(len(ids)))


def test_quality_rejects_and_keeps(spark):
    clean = " ".join(f"word{i} of{i} some{i * 7} text{i}" for i in range(30))
    junk = " ".join(f"w{i}***" for i in range(100))
    bytes_only = " ".join(chr(0x16A0 + i % 70) + chr(0x16A0 + i // 2) for i in range(100))
    rows = frame(spark, [(1, clean), (2, junk), (3, "too short"), (4, "same words again " * 40), (5, bytes_only)])
    rules = op10_quality.Rules(bands=op10_quality.Rules().bands | {"other": op10_quality.Band((0.0, 99.0), (0.0, 0.5), (0.0, 1.0))})
    got = {r.doc_id: r for r in op10_quality.quality_report(rows, PIECES, rules).collect()}
    assert [i for i in got if got[i].kept] == [1]
    assert [i for i in got if got[i].base_failed] == [3, 4] and got[5].byte_share > 0.5
    assert [r.doc_id for r in op10_quality.keep_good(rows, PIECES, rules).collect()] == [1]


def test_quality_of_odd_rows(spark):
    docs = odd_docs(spark)
    report = op10_quality.quality_report(docs, PIECES).collect()
    assert len(report) == len(ROWS)
    kept = op10_quality.keep_good(docs, PIECES)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in report)
    assert op10_quality.keep_good(docs.where("false"), PIECES).count() == 0


def test_long_pieces_stay_out_of_the_lexicon(spark):
    """A frequent piece of a megabyte is merged, not sent to the driver; ids are the tokenizer's."""
    long = "xyz" * 350_000
    docs = frame(spark, [(i, f"some words {long} again" if i < 3 else "some words and some") for i in range(6)])
    pieces = [r.piece for r in op2_bpe.lexicon_words(docs).collect()]
    assert "words" in pieces and max(len(p.encode()) for p in pieces) <= op2_bpe.PIECE_BYTES
    path = public_path(op2_bpe.TOKENIZER)
    rows = {r.doc_id: r for r in op2_bpe.digests(docs, path, ["doc_id"]).collect()}
    ids = Tokenizer.from_file(path).encode(f"some words {long} again", add_special_tokens=False).ids
    assert {rows[i].ids_sha256 for i in range(3)} == {hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()}


def test_equal_lexicons_are_published_once(spark):
    docs = frame(spark, [(i, "a few words of a few texts") for i in range(4)])
    path = public_path(op2_bpe.TOKENIZER)
    assert op2_bpe.publish_lexicon(docs, path) == op2_bpe.publish_lexicon(docs, path)


def plain_verdict(model, doc_id, text):
    """All columns of the query for one text, word by word."""
    import unicodedata

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n_words, word_chars, n_symbols, n_dup, n_repeat = plain_counts(text or "")
    failed = n_words < 50 or 100 * n_repeat > 50 * n_words
    ids, by_script = [], Counter()
    for word in words:
        ids += model.encode(word)
        letter = next((c for c in word if ord(c) > 127 and c.isalpha()), "a")
        ends = [(0x24F, 0), (0x36F, 5), (0x3FF, 1), (0x52F, 2), (0x5FF, 5), (0x6FF, 3), (0x2FFF, 5), (0x9FFF, 4), (0x10FFFF, 5)]
        by_script[next(k for end, k in ends if ord(letter) <= end)] += len(word)
    weights = [by_script[0] // 4, *(by_script[k] for k in range(1, 6))]
    script = op10_quality.SCRIPTS[weights.index(max(weights))]
    n = len(ids)
    letters = sum(unicodedata.category(c)[0] in "LMN" for w in words for c in w)
    share = np.array(list(Counter(ids).values())) / max(n, 1)
    figures = {
        "chars_per_token": letters / max(n, 1), "byte_share": sum(model.is_byte(i) for i in ids) / max(n, 1),
        "token_entropy": float(-(share * np.log2(share)).sum() / np.log2(n)) if n > 1 else 0.0,
    }
    band = op10_quality.Rules().bands[script]
    inside = all(getattr(band, k)[0] - 1e-12 <= v <= getattr(band, k)[1] + 1e-12 for k, v in figures.items())
    kept = not failed and (inside or n < 50)
    return (doc_id, n_words, word_chars, n_symbols, n_dup, n_repeat, failed, kept, n, script), figures


def test_quality_query_equals_plain_verdicts(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = {r.doc_id: r.text for r in documents(spark, SMALL).select("doc_id", "text").collect()}
    rows = op10_quality.op10_quality(spark, SMALL).collect()
    assert len(rows) == documents(spark, SMALL).count() and {r.kept for r in rows} == {True, False}
    for r in rows:
        want, figures = plain_verdict(model, r.doc_id, docs[r.doc_id])
        names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_tokens", "script")
        assert tuple(r[n] for n in names) == want
        assert all(r[name] == pytest.approx(value, abs=1e-9) for name, value in figures.items())

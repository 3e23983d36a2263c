"""The pipeline stage by stage against brute force, on documents with odd rows added."""

import hashlib

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from ampline.llm import op2_bpe, op4_mixing, op8_simhash, op10_quality
from ampline.llm.common import documents
from ampline.llm.tokenizer import public_path
from tests.llm.data import SMALL, odd_docs
from tests.llm.test_duplicates import lowered, plain_components, plain_fingerprint


def test_names():
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in queries())] == []
    assert queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in oracle_sql()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "exact dedup", "SimHash near-dedup", "mixing sources to target weights", "BPE encoding and decoding"
    ]


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark):
    docs = documents(spark, SMALL)
    step = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r.text for r in docs.collect()}

    good = step["quality rules"](spark, docs, SMALL)
    figures = op10_quality.measure(pa.array(list(rows.values())), public_path(op10_quality.TOKENIZER))
    op10_quality.judge(figures, op10_quality.Rules())
    rows = {i: t for (i, t), keep in zip(rows.items(), figures["kept"]) if keep}
    assert good.columns == docs.columns and ids(good) == sorted(rows)

    single = step["exact dedup"](spark, good, SMALL)
    last = {lowered(t): i for i, t in sorted(rows.items())}
    rows = {i: rows[i] for i in last.values()}
    assert single.columns == docs.columns and ids(single) == sorted(rows)

    apart = step["SimHash near-dedup"](spark, single, SMALL)
    order = sorted(rows)
    kept = sorted(set(plain_components(order, [plain_fingerprint(rows[i]) for i in order])))
    assert apart.columns == docs.columns and ids(apart) == kept

    mixed = step["mixing sources to target weights"](spark, apart, SMALL)
    report = op4_mixing.mix_report(apart, op4_mixing.labels_of(spark, SMALL)).collect()
    sure = {r.doc_id for r in report if r.rate * op4_mixing.HEADROOM >= 1}
    assert mixed.columns == docs.columns and sure <= set(ids(mixed)) <= set(kept)
    assert not {r.doc_id for r in report if r.rate == 0} & set(ids(mixed))

    tokenizer = Tokenizer.from_file(public_path(op2_bpe.TOKENIZER))
    for r in step["BPE encoding and decoding"](spark, mixed, SMALL).collect():
        want = tokenizer.encode(rows[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("empty", [True, False])
def test_stages_pass_odd_rows_on(spark, empty):
    docs = odd_docs(spark).where("false") if empty else odd_docs(spark)
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, SMALL)
        assert out.columns == docs.columns and out.count() <= docs.count(), name
    assert op8_simhash.SHINGLE_WORDS == 4 and op8_simhash.DISTANCE == 4

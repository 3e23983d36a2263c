"""Named queries over the table of documents."""

from __future__ import annotations

from ampline.llm.op1_pii import op1_pii
from ampline.llm.op2_bpe import op2_bpe
from ampline.llm.op3_repeats import op3_repeats
from ampline.llm.op4_mixing import op4_mixing
from ampline.llm.op5_pfor import op5_pfor
from ampline.llm.op6_language import op6_language
from ampline.llm.op7_secrets import op7_secrets
from ampline.llm.op8_simhash import op8_simhash
from ampline.llm.op9_dedup import ORACLE_SQL as OP9_SQL
from ampline.llm.op9_dedup import op9_dedup
from ampline.llm.op10_quality import op10_quality
from ampline.llm.op11_runs import op11_runs
from ampline.llm.op12_shards import op12_shards
from ampline.llm.op13_negatives import ORACLE_SQL as OP13_SQL
from ampline.llm.op13_negatives import op13_negatives

QUERIES = {
    "op1_pii": op1_pii,
    "op2_bpe": op2_bpe,
    "op3_repeats": op3_repeats,
    "op4_mixing": op4_mixing,
    "op5_pfor": op5_pfor,
    "op6_language": op6_language,
    "op7_secrets": op7_secrets,
    "op8_simhash": op8_simhash,
    "op9_dedup": op9_dedup,
    "op10_quality": op10_quality,
    "op11_runs": op11_runs,
    "op12_shards": op12_shards,
    "op13_negatives": op13_negatives,
}

ORACLES: dict[str, str] = {
    "op9_dedup": OP9_SQL,
    "op13_negatives": OP13_SQL,
}

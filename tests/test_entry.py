"""The entry offers the event queries whatever the document part lacks."""

import subprocess
import sys
from pathlib import Path

import pytest

from ampline.plans.catalogue import QUERIES

HIDE = """
import sys
for name in sys.argv[1:]:
    sys.modules[name] = None  # importing it raises ImportError
import __spark_entry__
print(*__spark_entry__.queries())
print(len(__spark_entry__.oracle_sql()))
"""


@pytest.mark.parametrize("hidden", ["xxhash", "tokenizers", "sentencepiece", "public_tokenizers", "ampline.llm", "corpus_pipeline", "pandas"])
def test_event_queries_without_a_library_of_the_document_part(hidden):
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", HIDE, hidden], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    names, n_sql = done.stdout.strip().rsplit("\n", 1)
    assert set(QUERIES) <= set(names.split()) and int(n_sql) >= len(QUERIES)

"""The public tokenizer files, opened once per process."""

from __future__ import annotations

import os
from functools import lru_cache


@lru_cache(maxsize=4)
def open_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def id_lists(path: str):
    """A function from texts to their lists of ids."""
    tokenizer = open_tokenizer(path)
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

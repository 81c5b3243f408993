"""Token ids of whole texts, by a public vocabulary."""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

from cabrank.llm.common import give_back

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: The quick encoder's stack holds about ten times as long a run of white space.
BLANKS = 100_000
LONG_BLANK = re.compile(rf"\s{{{BLANKS}}}")


@lru_cache(maxsize=4)
def encoder(path: str = RANKS) -> tiktoken.Encoding:
    """The rank file holds the vocabulary of ``byte_bpe_50k.json``; ids are the same and come several times faster."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def whole_tokenizer(path: str = VOCABULARY) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def encode(text: str | None, path: str = RANKS, vocabulary: str = VOCABULARY) -> list[int]:
    """Ids of a whole text; NULL is empty. Special strings inside a text are ordinary text.

    A long run of white space overflows the stack of the quick encoder, which
    matches by backtracking there; such a text goes to ``tokenizers`` with the
    same vocabulary, whose ids are the same.
    """
    if not text:
        return []
    if len(text) >= BLANKS and LONG_BLANK.search(text):
        return whole_tokenizer(vocabulary).encode(text, add_special_tokens=False).ids
    return encoder(path).encode_ordinary(text)


def token_ids(text: str | None, path: str = RANKS) -> np.ndarray:
    return np.frombuffer(array("I", encode(text, path)), np.uint32)


def rows_of(batches: Iterator[pa.RecordBatch], *names: str, most: int = 256) -> Iterator[list[tuple]]:
    """The named columns of some rows at a time, so that what is made of a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            yield list(zip(*(part.column(name).to_pylist() for name in names), strict=True))
            del part
        del batch
        give_back()

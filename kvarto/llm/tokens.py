"""Sizes of texts in tokens of a public subword tokenizer, and tokens with their places."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: where the vocabulary files lie on every machine; a parameter of all operators that count tokens
VOCABULARY = os.environ.get("KVARTO_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: fixed value: the pattern that the vocabulary's pieces were cut by
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def tokenizer(path: str = VOCABULARY) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def token_count(text: str | None, path: str = VOCABULARY) -> int:
    return len(tokenizer(path).encode_ordinary(text)) if text else 0


def token_ends(text: str, path: str = VOCABULARY) -> np.ndarray:
    """For each token, the character position where it ends; a token that ends inside a character counts to that character's end."""
    enc = tokenizer(path)
    sizes = [len(b) for b in enc.decode_tokens_bytes(enc.encode_ordinary(text))]
    ends = np.cumsum(sizes, dtype=np.int64)
    if text.isascii():
        return ends
    lead = (np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8) & 0xC0) != 0x80
    return np.cumsum(lead)[ends - 1]


def with_tokens(df: DataFrame, id_col: str, text_col: str, keep: list[str] | None = None, path: str = VOCABULARY) -> DataFrame:
    """(id, kept columns.., tokens) of every row; null and empty texts have 0 tokens. The text itself isn't carried on."""
    keep = keep or []

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = tokenizer(path)
        for batch in batches:
            batch["tokens"] = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.pop("text__")]
            yield batch

    chosen = df.select(F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("text__"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields if f.name != "text__")
    return chosen.mapInPandas(count, f"{fields}, tokens long")

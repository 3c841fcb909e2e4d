"""Token counts of texts under a public byte-level BPE, counted in Arrow batches."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where the vocabulary lies on every machine; a parameter of all operators.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pre-token pattern of the public byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoding(path: str = VOCABULARY):
    """The encoder over the ranks in ``path``, loaded once per worker process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of the whole text; 0 for null and empty text."""

    @F.pandas_udf(T.LongType())
    def counted(texts: pd.Series) -> pd.Series:
        enc = encoding(vocabulary)
        return pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return counted(text)


def measured(documents: DataFrame, columns: list[str], text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``columns`` and ``tokens`` of every row; the text itself goes no further."""
    return documents.select(*columns, count_tokens(F.col(text), vocabulary).alias("tokens"))

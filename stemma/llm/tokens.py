"""Token counts of texts by a public byte-level vocabulary, whose path is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern that belongs to the vocabulary: it splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


_SHIPPED: set[tuple[str, str]] = set()


def ship(path: str) -> None:
    """Give the workers the vocabulary with the job, once per application; it need not lie on their machines."""
    spark = SparkSession.getActiveSession()
    if spark is not None and (spark.sparkContext.applicationId, path) not in _SHIPPED:
        _SHIPPED.add((spark.sparkContext.applicationId, path))
        spark.sparkContext.addFile(path)


@lru_cache(maxsize=4)
def encoding(path: str):
    import tiktoken

    shipped = SparkFiles.get(os.path.basename(path)) if not os.path.exists(path) else path
    with open(shipped, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("stemma", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def n_tokens(text: Column, path: str = VOCABULARY) -> Column:
    """Number of tokens of the whole text; null and empty texts have none."""
    ship(path)

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(path)
        for batch in batches:
            yield pd.Series([0 if t is None else len(enc.encode_ordinary(t)) for t in batch], dtype="int32")

    return count(text)


def token_ids(text: Column, path: str = VOCABULARY) -> Column:
    """Tokens of the whole text; null and empty texts have none."""
    ship(path)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(path)
        for batch in batches:
            yield pd.Series([[] if t is None else enc.encode_ordinary(t) for t in batch])

    return ids(text)

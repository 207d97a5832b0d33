"""Token counts and token vectors of documents by a public tokenizer read from a folder of vocabulary files."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the vocabulary files and the one used, a byte-level BPE as ranks.
FOLDER, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenization pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoder(folder: str = FOLDER, vocabulary: str = VOCABULARY):
    """The tokenizer, once per Python worker; strings of special tokens in a text are ordinary text."""
    import tiktoken

    ranks = {}
    for line in Path(folder, vocabulary).read_bytes().splitlines():
        token, rank = line.split()
        ranks[base64.b64decode(token)] = int(rank)
    return tiktoken.Encoding(vocabulary, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_count(documents: DataFrame, text: str, name: str = "n_tokens", folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """``documents`` with ``text`` replaced by its number of tokens; NULL and empty texts have none."""
    rest = [c for c in documents.columns if c != text]
    schema = documents.select(*(f"`{c}`" for c in rest)).schema.add(name, "long")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(folder, vocabulary).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t)) if t else 0 for t in batch[text]]
            yield batch[rest].assign(**{name: sizes})

    return documents.mapInPandas(count, schema)


def token_vectors(documents: DataFrame, key: str, text: str, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """``key``, ``n_tokens`` and the distinct tokens with their frequencies, packed: ``terms`` and ``tfs`` (uint32)."""
    schema = f"`{key}` {documents.schema[key].dataType.simpleString()}, n_tokens long, terms binary, tfs binary"

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(folder, vocabulary).encode_ordinary
        for batch in batches:
            sizes, terms, tfs = [], [], []
            for t in batch[text]:
                ids = np.array(encode(t) if t else (), dtype=np.uint32)
                unique, counts = np.unique(ids, return_counts=True)
                sizes.append(ids.size)
                terms.append(unique.tobytes())
                tfs.append(counts.astype(np.uint32).tobytes())
            yield pd.DataFrame({key: batch[key], "n_tokens": sizes, "terms": terms, "tfs": tfs})

    return documents.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInPandas(vectors, schema)

"""Texts as ids of a public vocabulary, text by text: for blocks and masks that are built where the texts are."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the published pre-token pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenize(df: DataFrame, text: str, vocabulary: str, ids: str = "ids", longest: int | None = None) -> DataFrame:
    """df with the token ids of a column, cut at ``longest`` if given; null gives null, the empty text an empty list.

    ``vocabulary`` is a file of ranks that every executor can read. Special tokens are ordinary text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("tokenize", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            got = [None if t is None else enc.encode_ordinary(t)[:longest] for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.list_(pa.int32()))], names=[*b.schema.names, ids])

    return df.mapInArrow(run, df.withColumn(ids, F.lit(None).cast("array<int>")).schema)

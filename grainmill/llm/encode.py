"""Encoding a whole corpus with a public byte-level BPE tokenizer, and decoding it again.

Method: a global shuffle of distinct words. Texts are cut into pre-tokens with positions inside the JVM, each distinct
pre-token is encoded once, its ids are joined back and every text is put together by position. Frequent pre-tokens
never leave their text: they travel as two-byte codes in place. Decoding joins the table of token bytes.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.session import hot_split_join, materialize

#: Fixed value: the published pre-token pattern of this vocabulary; (?U) gives white space its Unicode meaning in Java.
PRE_TOKEN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k"
#: Pre-tokens above this share of all are frequent, so there are fewer than 1/share; those longer than so many
#: characters aren't taken for it, which bounds the bytes of the list that every executor gets.
FREQUENT_SHARE = 1 / 20_000
FREQUENT_CHARS = 64


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _encode_words(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        # one pre-token at a time comes in, so the pattern here must not cut it again
        enc = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=_ranks(path), special_tokens={})
        for b in batches:
            yield pd.DataFrame({"word": b["word"], "n": b["n"], "piece": [enc.encode_ordinary(w) for w in b["word"]]})

    return run


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, folder: str = TOKENIZER_DIR
) -> DataFrame:
    """Rows (id_col, ids): the token ids of every text, without special tokens.

    Null and empty texts give an empty list, never null; blank texts are encoded as they stand. Text that looks like a
    special token is ordinary text. Rows repeated with the same id and text count once; the same id with two texts
    gives a row for each. Other columns are ignored whatever their names. An empty table gives no rows.

    Frequent pre-tokens are replaced by codes inside their text; the others are exploded with their positions, meet
    their ids in a shuffle join without hot keys (long frequent ones by broadcast), and return to their text.
    """
    path = os.path.join(folder, f"{vocabulary}.tiktoken")
    cut = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_h"), F.regexp_extract_all(text_col, F.lit(PRE_TOKEN), F.lit(0)).alias("words"))
    words = cut.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    encoded = materialize(words.mapInPandas(_encode_words(path), "word string, n long, piece array<int>"), "words")
    total = encoded.agg(F.sum("n")).first()[0] or 0
    often = (F.col("n") > total * FREQUENT_SHARE) & (F.length("word") <= FREQUENT_CHARS)
    frequent = encoded.where(often).select("word", "piece").toPandas()  # fewer than 1/FREQUENT_SHARE rows
    kind = docs.schema[id_col].dataType.simpleString()
    coded = cut.mapInArrow(_code(list(frequent["word"])), f"_id {kind}, _h long, codes binary, at array<int>, word array<string>")
    # identical rows count once; partial aggregation keeps repeats of one row from meeting
    coded = materialize(coded.groupBy("_id", "_h").agg(F.first("codes").alias("codes"), F.first(F.arrays_zip("at", "word")).alias("rest")), "coded")
    rest = coded.select("_id", "_h", F.inline("rest").alias("at", "word"))
    joined = hot_split_join(rest, encoded.where(~often), "word", "n", keep_key=False)
    back = joined.groupBy("_id", "_h").agg(F.collect_list("at").alias("at"), F.collect_list("piece").alias("piece"))
    b = back.select(F.col("_id").alias("_bid"), F.col("_h").alias("_bh"), "at", "piece")
    both = coded.select("_id", "_h", "codes").join(b.hint("shuffle_merge"), F.col("_id").eqNullSafe(F.col("_bid")) & (F.col("_h") == F.col("_bh")), "left")
    return both.select("_id", "codes", "at", "piece").mapInArrow(_assemble([list(x) for x in frequent["piece"]]), f"_id {kind}, ids array<int>").withColumnRenamed("_id", id_col)


def _code(frequent: list[str]):
    """(_id, _h, words) to (_id, _h, codes, at, word): a two-byte code for each frequent word, -1 and the word itself for others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(frequent, pa.string())
        for b in batches:
            lists = b.column("words")
            flat = lists.flatten().cast(pa.string())
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(n)
            starts = ends - n
            code = pc.fill_null(pc.index_in(flat, known), -1).to_numpy(zero_copy_only=False).astype(np.int16)
            rare = np.flatnonzero(code < 0)
            of = np.searchsorted(ends, rare, "right")
            offsets = pa.array(np.r_[0, np.searchsorted(rare, ends)].astype(np.int32))
            codes = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.r_[0, 2 * ends].astype(np.int32)), pa.py_buffer(code)])
            at = pa.ListArray.from_arrays(offsets, pa.array((rare - starts[of]).astype(np.int32)))
            word = pa.ListArray.from_arrays(offsets, flat.take(pa.array(rare)))
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_h"), codes, at, word], names=["_id", "_h", "codes", "at", "word"])

    return run


def _assemble(frequent: list[list[int]]):
    """(_id, codes, at, piece) to (_id, ids): the ids of every text in order of position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array([x for p in frequent for x in p], np.int32)
        sizes = np.array([len(p) for p in frequent], np.int64)
        for b in batches:
            raw = b.column("codes")
            n = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64) // 2
            starts = np.cumsum(n) - n
            code = np.frombuffer(b"".join(raw.to_pylist()), np.int16).astype(np.int64)
            # where each rare word's ids lie behind the table of the frequent ones
            lists, pieces = b.column("at"), b.column("piece").flatten()
            m = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            place = np.repeat(starts, m) + lists.flatten().to_numpy(zero_copy_only=False)
            own = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = np.concatenate([table, pieces.flatten().to_numpy(zero_copy_only=False).astype(np.int32)])
            size = np.concatenate([sizes, own])
            first = np.cumsum(size) - size
            which = code.copy()
            which[place] = len(sizes) + np.arange(len(place))
            long = size[which]
            total = np.cumsum(long)
            take = np.repeat(first[which] - (total - long), long) + np.arange(int(total[-1]) if len(total) else 0)
            ends = np.r_[0, total][np.r_[0, starts + n]]
            out = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids[take], pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("_id"), out], names=["_id", "ids"])

    return run


def token_bytes(spark, vocabulary: str = VOCABULARY, folder: str = TOKENIZER_DIR) -> DataFrame:
    """The token table (id, hex): as long as the vocabulary, so a broadcast of it is bounded by a constant."""
    ranks = _ranks(os.path.join(folder, f"{vocabulary}.tiktoken"))
    return spark.createDataFrame([(i, b.hex()) for b, i in ranks.items()], "id int, hex string")


def decode(encoded: DataFrame, id_col: str = "doc_id", vocabulary: str = VOCABULARY, folder: str = TOKENIZER_DIR) -> DataFrame:
    """Rows (id_col, text) for rows (id_col, ids): the bytes of every id, joined by position. Empty lists give ''.

    An id that the vocabulary doesn't have gives no bytes. Ids must be unique per id_col.
    """
    table = token_bytes(encoded.sparkSession, vocabulary, folder)
    parts = encoded.select(F.col(id_col).alias("_id"), F.posexplode_outer("ids").alias("_p", "id"))
    joined = parts.join(F.broadcast(table), "id", "left")
    got = joined.groupBy("_id").agg(F.array_sort(F.collect_list(F.when(F.col("hex").isNotNull(), F.struct("_p", "hex")))).alias("_l"))
    text = F.decode(F.unhex(F.array_join(F.transform("_l", lambda x: x["hex"]), "")), "UTF-8")
    return got.select(F.col("_id").alias(id_col), text.alias("text"))

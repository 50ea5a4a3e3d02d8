"""Token blocks for training: masks, packing one entry to a block, chunking a stream of tokens."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.operators.ordered import running_sum

IGNORED = -100


def _ends(ids: np.ndarray, mark: list[int]) -> np.ndarray:
    """Places just after every occurrence of the mark."""
    n = len(ids) - len(mark) + 1
    if n <= 0:
        return np.empty(0, np.int64)
    hit = np.ones(n, bool)
    for d, x in enumerate(mark):
        hit &= ids[d : d + n] == x
    return np.flatnonzero(hit) + len(mark)


def mask_of(ids: np.ndarray, answer_marks: list[list[int]], question: list[int], line_question: list[int]) -> np.ndarray:
    """The labels of one entry, see ``label_mask``."""
    begins = np.unique(np.concatenate([_ends(ids, m) for m in answer_marks]))
    if not len(begins):
        return ids
    stops = _ends(ids, line_question) - len(line_question)
    if list(ids[: len(question)]) == question:
        stops = np.r_[0, stops]
    stops = np.r_[np.sort(stops), len(ids)]
    # +1 where an answer begins, -1 where it ends: inside where the sum is positive
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, begins, 1)
    np.add.at(edge, stops[np.searchsorted(stops, begins)], -1)
    return np.where(np.cumsum(edge[:-1]) > 0, ids, IGNORED)


def label_mask(df: DataFrame, ids: str, answer_marks: list[list[int]], question: list[int], line_question: list[int]) -> DataFrame:
    """Adds labels: the ids inside answers, -100 elsewhere; all ids where there is no answer mark (prose).

    An answer runs from just after its mark to the next question mark (at the very start of the text, or one that
    begins a line) or the end. Null ids give null labels, empty ones empty labels. Linear in the length of an entry.
    """

    @F.pandas_udf("array<int>")
    def labels(col: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else mask_of(np.asarray(x), answer_marks, question, line_question).astype(np.int32) for x in col])

    return df.withColumn("labels", labels(ids))


def pack_entries(df: DataFrame, ids: str, labels: str, seq_len: int, eos: int) -> DataFrame:
    """One block of exactly ``seq_len`` for each entry: cut, or one end mark that counts and end marks that don't.

    Entries without ids are left out; other columns stay.
    """
    i, l = F.slice(ids, 1, seq_len), F.slice(labels, 1, seq_len)
    missing = F.greatest(F.lit(seq_len) - F.size(ids), F.lit(0))
    pad = F.array_repeat(F.lit(eos), missing)
    mask = F.when(missing > 0, F.concat(F.array(F.lit(eos)), F.array_repeat(F.lit(IGNORED), missing - 1))).otherwise(F.array().cast("array<int>"))
    rest = [c for c in df.columns if c not in (ids, labels)]
    return df.where(F.size(ids) > 0).select(*rest, F.concat(i, pad).alias("input_ids"), F.concat(l, mask).alias("labels"))


def chunk(df: DataFrame, group: str, order: str, ids: str, block: int) -> DataFrame:
    """(group, block_no, input_ids): the ids of a group in order, cut into blocks; the rest that fills none is dropped.

    ``order`` is a number, unique in its group. Rows are placed by a running sum of their sizes and cut where blocks
    end, so a group of any size is put together block by block and never as a whole.
    """
    x = df.where(F.col(ids).isNotNull() & (F.size(ids) > 0)).select(group, order, F.col(ids).alias("_ids"))
    end = running_sum(x, group, order, F.size("_ids"), "_end")
    begin = F.col("_end") - F.size("_ids")
    cut = end.select(group, begin.alias("_at"), "_end", "_ids", F.explode(F.sequence(F.floor(begin / block), F.floor((F.col("_end") - 1) / block))).alias("_no"))
    lo, hi = F.greatest("_at", F.col("_no") * block), F.least("_end", (F.col("_no") + 1) * block)
    part = cut.select(group, F.col("_no").cast("int").alias("block_no"), lo.alias("_lo"), F.slice("_ids", (lo - F.col("_at") + 1).cast("int"), (hi - lo).cast("int")).alias("_part"))
    g = part.groupBy(group, "block_no").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_lo", "_part"))), lambda s: s["_part"])).alias("input_ids"))
    return g.where(F.size("input_ids") == block)

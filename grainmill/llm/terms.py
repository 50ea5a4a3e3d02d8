"""Frequency of every distinct term: how often it occurs, in how many records, and whether it is too rare or too common.

Method: a range-partitioned external sort of (term, record id) pairs, then run-length scanning of the sorted
partitions. A term whose run crosses partitions leaves one partial count in each, which a last small step adds up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A term is rare in at most so many records, and common in more than one in so many of all records.
RARE_RECORDS = 2
COMMON_ONE_IN = 20
#: Bytes of pairs that a range is meant to have, by the characters of the texts; above LEAST_BYTES * RANGES altogether it
#: grows, up to MOST_BYTES, so that their number stays in bounds.
BYTES_PER_CHAR = 2.5
LEAST_BYTES, MOST_BYTES, RANGES = 8 << 20, 256 << 20, 4000


def _changes(a: pa.Array, last) -> np.ndarray:
    """Whether each value differs from the one before; ``last`` is the value before the first."""
    out = np.ones(len(a), bool)
    if len(a) > 1:
        out[1:] = pc.not_equal(a.slice(1), a.slice(0, len(a) - 1)).to_numpy(zero_copy_only=False)
    out[0] = last is None or a[0].as_py() != last
    return out


def scan_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (term, rec, pos) to (term, occurrences, records), one row for each run of a term.

    A second delivery repeats (term, rec, pos) and counts once. Memory is one batch, however long a run is.
    """
    names = ["term", "occurrences", "records"]
    run: list | None = None
    last = (None, None)
    for b in batches:
        if not b.num_rows:
            continue
        term, rec, pos = b.column(0), b.column(1), b.column(2)
        t_new = _changes(term, run[0] if run else None)
        r_new = t_new | _changes(rec, last[0])
        p_new = r_new | _changes(pos, last[1])
        starts = np.flatnonzero(t_new)
        at = starts if t_new[0] else np.concatenate([[0], starts])
        occ, num = np.add.reduceat(p_new.astype(np.int64), at), np.add.reduceat(r_new.astype(np.int64), at)
        terms = term.take(pa.array(at)).to_pylist()
        occ, num = occ.tolist(), num.tolist()
        if run is not None:
            if t_new[0]:
                terms, occ, num = [run[0], *terms], [run[1], *occ], [run[2], *num]
            else:
                occ[0] += run[1]
                num[0] += run[2]
        run = [terms.pop(), occ.pop(), num.pop()]
        last = rec[b.num_rows - 1].as_py(), pos[b.num_rows - 1].as_py()
        if terms:
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(occ, pa.int64()), pa.array(num, pa.int64())], names=names)
    if run is not None:
        yield pa.RecordBatch.from_arrays([pa.array([run[0]], pa.string()), pa.array([run[1]], pa.int64()), pa.array([run[2]], pa.int64())], names=names)


def n_ranges(size: float) -> int:
    """How many ranges pairs of so many bytes are sorted in."""
    return max(1, math.ceil(size / min(MOST_BYTES, max(LEAST_BYTES, size / RANGES))))


def term_counts(records: DataFrame, id_col: str = "block_id", fields: tuple[str, ...] = ("q", "a")) -> DataFrame:
    """Rows (term, occurrences, records) for every distinct term of the fields.

    A term is a maximal run of letters or digits of any script, after lower-casing. A record is one id; second
    deliveries of an id (same words) count once. Null fields have no terms; rows with a null id are left out. An empty
    table gives no rows.

    The sort key is (term, record), so a term that fills a third of the corpus is spread over as many ranges as its
    rows need, and the number of ranges follows from the size of the texts; no task holds a term's records.
    """
    chars = records.agg(F.sum(sum(F.coalesce(F.length(f), F.lit(0)) for f in fields).cast("double"))).first()[0] or 0.0
    text = F.lower(F.concat_ws(" ", *[F.col(f) for f in fields]))
    pairs = (
        records.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("rec"), F.posexplode(F.split(text, r"[^\p{L}\p{N}]+")).alias("pos", "term"))
        .where("term <> ''")
        .select("term", "rec", "pos")
    )
    runs = pairs.repartitionByRange(n_ranges(chars * BYTES_PER_CHAR), "term", "rec").sortWithinPartitions("term", "rec", "pos").mapInArrow(scan_runs, "term string, occurrences long, records long")
    return runs.groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))


def n_records(records: DataFrame, id_col: str = "block_id") -> DataFrame:
    """One row (n_records): the number of distinct ids of the whole table, whatever its rows hold."""
    return records.select(id_col).distinct().agg(F.count(id_col).alias("n_records"))


def marked_terms(records: DataFrame, id_col: str = "block_id", fields: tuple[str, ...] = ("q", "a"), rare: int = RARE_RECORDS, common_one_in: int = COMMON_ONE_IN) -> DataFrame:
    """Rows (term, occurrences, records, mark): mark is rare, common or null.

    rare: in at most ``rare`` records; common: in more than 1/common_one_in of all distinct ids. A term that is both
    (in tiny tables) is rare. The other rules are those of ``term_counts``.
    """
    n = n_records(records, id_col).first()[0]  # one number
    mark = F.when(F.col("records") <= rare, "rare").when(F.col("records") * common_one_in > n, "common")
    return term_counts(records, id_col, fields).withColumn("mark", mark)

"""Collapsing records that differ only in formatting, and counting the copies of each.

Method: progressive partition refinement. Records are first classed by cheap invariants that no change of white space,
letter case, punctuation or field order can alter (number of letters and digits, letter histogram); only members of
classes with several distinct records go on to the costly exact key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.llm.bitmap import bitmap_of, kept
from grainmill.session import hot_split_join, materialize

#: Letters counted together by the histogram of the first refinement; any choice is correct, frequent ones separate best.
HISTOGRAM = ("et", "ao", "in", "srld")


def words_text(c: Column | str) -> Column:
    """The words of a text, one blank between two: maximal runs of letters or digits after lower-casing; null gives ''."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def invariant(*fields: str) -> Column:
    """A string equal for records that are equal apart from formatting and field order: length and letter histogram."""
    s = F.regexp_replace(F.lower(F.concat(*[F.coalesce(F.col(f), F.lit("")) for f in fields])), r"[^\p{L}\p{N}]+", "")
    return F.struct(F.lit(0), s.alias("s"))["s"]


def _classes(records: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """Step 1: (id, class key, fields)."""
    stripped = records.select(F.col(id_col).alias("_id"), *[F.col(f).alias(f"_f{i}") for i, f in enumerate(fields)]).withColumn(
        "_s", invariant(*[f"_f{i}" for i in range(len(fields))])
    )
    n = F.length("_s")
    counts = [F.length(F.translate("_s", letters, "")) for letters in HISTOGRAM]
    return stripped.withColumn("_c", F.concat_ws(".", n, *counts)).drop("_s")


def copies(records: DataFrame, id_col: str = "pair_id", fields: tuple[str, ...] = ("q", "a")) -> DataFrame:
    """Rows (id, keep_id, n_copies): every record with the kept record of its set and the size of the set.

    Two records are the same if their fields hold the same words in the same order, whichever field holds which; null
    equals empty. The kept record has the smallest id. A repeated id (second delivery) counts once; if its deliveries
    differ in words, each is a record of its own under that id. Records without words in any field are equal to each
    other. A null id is left out, as nothing could name it. Ties cannot occur. An empty table gives no rows.
    """
    fields_ = list(fields)
    rec = _classes(records.where(F.col(id_col).isNotNull()), id_col, fields_)
    # 1: classes by cheap invariants; only (class, id) moves, pre-aggregated before the shuffle
    sizes = rec.groupBy("_c").agg(F.count("*").alias("_n"), F.min("_id").alias("_lo"), F.max("_id").alias("_hi"))
    sizes = materialize(sizes.where(F.col("_lo") != F.col("_hi")).drop("_lo", "_hi"), "classes")
    # 2: the exact key, inside classes with several records only: a bitmap of these drops nearly all other records where
    # they stand, and keys of the few more that it lets through meet nobody
    inside = kept(rec.withColumn("_h", F.xxhash64("_c")).drop("_c"), "_h", *bitmap_of(sizes.select(F.xxhash64("_c").alias("_h")), "_h"))
    key = F.sha2(F.concat_ws("\n", F.array_sort(F.array(*[words_text(f"_f{i}") for i in range(len(fields_))]))), 256)
    keyed = materialize(inside.select("_id", key.alias("_k")).distinct(), "keys")
    sets = materialize(keyed.groupBy("_k").agg(F.min("_id").alias("keep_id"), F.count("*").alias("n_copies")).where("n_copies > 1"), "sets")
    several = hot_split_join(keyed, sets.withColumn("_n", F.col("n_copies")), "_k", "_n")
    return several.select(F.col("_id").alias(id_col), "keep_id", "n_copies")


def collapsed(records: DataFrame, id_col: str = "pair_id", fields: tuple[str, ...] = ("q", "a")) -> DataFrame:
    """Rows (keep_id, n_copies): one row for every different record, single ones with n_copies 1.

    The same rules as ``copies``; null ids are left out.
    """
    multi = copies(records, id_col, fields)
    ids = records.where(F.col(id_col).isNotNull()).select(id_col).distinct()
    dropped = multi.where(F.col(id_col) != F.col("keep_id")).select(id_col)
    kept = multi.where(F.col(id_col) == F.col("keep_id")).select(id_col, "n_copies")
    return (
        ids.join(dropped, id_col, "left_anti")
        .join(kept, id_col, "left")
        .select(F.col(id_col).alias("keep_id"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"))
    )

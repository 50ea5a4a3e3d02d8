"""The pN_ queries and, where SQL can express them on whole tables, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.llm import canonical, defects, encode, forest, leaks, packing, terms, toxic
from grainmill.session import materialize


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return defects.defects(_table(spark, sf, "blocks")).select("block_id", "defect")


def p1_defects(spark: SparkSession, sf: str) -> DataFrame:
    """Every defect of every defective pair, one row each."""
    return defects.defects(_table(spark, sf, "blocks")).select("block_id", F.explode("defects").alias("defect"))


def p2_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The block of every pair, pairs longer than a block in pieces."""
    capacity = _table(spark, sf, "presets").where("preset = 'help_core'").first()["seq_len"]
    return packing.pack(_table(spark, sf, "pairs"), "pair_id", packing.pair_length(), capacity)


def p2_fill(spark: SparkSession, sf: str) -> DataFrame:
    """How many blocks there are by how full they are."""
    return p2_blocks(spark, sf).groupBy("block").agg(F.sum("piece_len").alias("fill")).groupBy("fill").agg(F.count("*").alias("n_blocks"))


def p3_groups(spark: SparkSession, sf: str) -> DataFrame:
    """One row for every answer of 12 or more words: its group."""
    return forest.near_groups(_table(spark, sf, "answers"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return forest.group_pairs(materialize(p3_groups(spark, sf), "groups"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    c = canonical.copies(_table(spark, sf, "pairs"))
    return c.where(F.col("pair_id") != F.col("keep_id")).select("keep_id", F.col("pair_id").alias("dup_id"))


def p4_collapsed(spark: SparkSession, sf: str) -> DataFrame:
    """One row for every different record with the number of its copies."""
    return canonical.collapsed(_table(spark, sf, "pairs"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return terms.marked_terms(_table(spark, sf, "blocks")).where("mark is not null").select("term", "mark")


def p5_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Every distinct term with its occurrences and records."""
    return terms.marked_terms(_table(spark, sf, "blocks"))


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode.encode(_table(spark, sf, "documents"))


def p6_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's text, encoded and decoded again; null texts come back empty."""
    return encode.decode(encode.encode(_table(spark, sf, "documents")))


def _p7(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaks(_table(spark, sf, "documents"), _table(spark, sf, "eval_items"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return _p7(spark, sf).select("doc_id", "item_id")


def p7_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """Every leak with the words covered and the least number of word edits."""
    return _p7(spark, sf)


def p8_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The score of every document."""
    return toxic.scores(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return p8_scores(spark, sf).where(F.col("score") >= toxic.THRESHOLD).select("doc_id").distinct()


def p8_rates(spark: SparkSession, sf: str) -> DataFrame:
    """The rate of flagged documents for each source."""
    return toxic.source_rates(p8_scores(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_defects": p1_defects,
    "p2_blocks": p2_blocks,
    "p2_fill": p2_fill,
    "p3_found": p3_found,
    "p3_groups": p3_groups,
    "p4_found": p4_found,
    "p4_collapsed": p4_collapsed,
    "p5_found": p5_found,
    "p5_terms": p5_terms,
    "p6_ids": p6_ids,
    "p6_round_trip": p6_round_trip,
    "p7_found": p7_found,
    "p7_leaks": p7_leaks,
    "p8_found": p8_found,
    "p8_scores": p8_scores,
    "p8_rates": p8_rates,
}

_WORDS = r"trim(regexp_replace(lower(coalesce({0}, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"

_P4 = f"""
rec AS (SELECT DISTINCT pair_id, {_WORDS.format('q')} AS wq, {_WORDS.format('a')} AS wa FROM pairs WHERE pair_id IS NOT NULL),
keyed AS (SELECT DISTINCT pair_id, least(wq, wa) AS k1, greatest(wq, wa) AS k2 FROM rec),
cls AS (SELECT pair_id, min(pair_id) OVER (PARTITION BY k1, k2) AS keep_id, count(*) OVER (PARTITION BY k1, k2) AS n FROM keyed)
"""

_P5 = r"""
tok AS (
  SELECT DISTINCT block_id, pos, term FROM (
    SELECT block_id, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM (
      SELECT block_id, regexp_extract_all(lower(concat_ws(' ', q, a)), '[\p{L}\p{N}]+') AS w FROM blocks WHERE block_id IS NOT NULL))),
terms AS (SELECT term, count(*) AS occurrences, count(DISTINCT block_id) AS records FROM tok GROUP BY term),
marked AS (
  SELECT term, occurrences, records,
         CASE WHEN records <= 2 THEN 'rare' WHEN records * 20 > (SELECT count(DISTINCT block_id) FROM blocks) THEN 'common' END AS mark
  FROM terms)
"""

SQL: dict[str, str] = {
    "p4_found": f"WITH {_P4} SELECT keep_id, pair_id AS dup_id FROM cls WHERE pair_id <> keep_id",
    "p4_collapsed": f"WITH {_P4} SELECT keep_id, n AS n_copies FROM cls WHERE pair_id = keep_id",
    "p5_found": f"WITH {_P5} SELECT term, mark FROM marked WHERE mark IS NOT NULL",
    "p5_terms": f"WITH {_P5} SELECT term, occurrences, records, mark FROM marked",
    "p6_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}

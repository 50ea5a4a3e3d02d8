"""Registering queries, and the tables with each delivery counted once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: The SQL side of the tables below.
CTE = {
    "A": "A AS (SELECT DISTINCT answer_id, path, line_no, a FROM answers)",
    "P": "P AS (SELECT DISTINCT pair_id, path, line_no, q, a, prefix FROM pairs)",
    "B": 'B AS (SELECT DISTINCT block_id, path, block_no, line_no, type, q, a, "do", text, next_line FROM blocks)',
    "L": """L AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM (
        SELECT doc_id, CASE WHEN t = '' THEN [] ELSE string_split(t, chr(10)) END AS ls FROM (
          SELECT doc_id, regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '\\n\\z', '') AS t FROM documents WHERE text IS NOT NULL)))""",
}


def query(name: str, sql: str | None = None, uses: str = ""):
    """Registers a query; ``uses`` names the shared parts its SQL begins with."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            parts = ", ".join(CTE[u] for u in uses)
            SQL[name] = f"WITH {parts} {sql}" if parts and not sql.lstrip().startswith(",") else (f"WITH {parts}{sql}" if parts else sql)
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def answers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "answers").select("answer_id", "path", "line_no", "a").distinct()


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pairs").select("pair_id", "path", "line_no", "q", "a", "prefix").distinct()


def blocks(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "blocks").drop("ingested_at").distinct()


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")

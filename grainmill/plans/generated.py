"""Generated questions for commands and passages, early forms of records, and the seven checks in one result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from grainmill.operators import generate as ge
from grainmill.operators import quality as ql
from grainmill.plans.base import QUERIES, SQL, blocks, documents, query, table

#: Verbs of commands with the words they are asked for by.
_VERBS = {"open": ["unlock", "start"], "close": ["shut", "lock"], "read": ["check", "show me"], "set": ["change", "adjust"], "show": ["display"], "reset": ["restart", "clear"]}
_VERB_ROWS = [(v, i, s) for v, ss in _VERBS.items() for i, s in enumerate([v, *ss])]
_COMMAND_SQL = f""", c AS (SELECT DISTINCT regexp_extract("do", '^[a-z]+') AS command FROM B WHERE type = 'do'), k AS (SELECT command, regexp_extract(command, '^({"|".join(_VERBS)})', 1) AS verb FROM c),
    n AS (SELECT command, verb, substr(command, length(verb) + 1) AS noun FROM k WHERE verb <> '' AND length(command) > length(verb)),
    s AS (SELECT * FROM (VALUES {", ".join(f"('{v}', {i}, '{x}')" for v, i, x in _VERB_ROWS)}) t(verb, i, synonym)),
    f AS (SELECT * FROM (VALUES {", ".join(f"({k}, '{x.replace(chr(39), chr(39) * 2)}')" for k, x in enumerate(ge.COMMAND_FRAMES))}) t(k, frame)),
    q AS (SELECT command, i, k, replace(replace(frame, '{{v}}', synonym), '{{n}}', noun) AS q FROM n JOIN s USING (verb), f),
    o AS (SELECT command, arg_min(q, (i, k)) AS q, min((i, k)) AS p FROM q GROUP BY command, lower(q)),
    h AS (SELECT DISTINCT regexp_extract("do", '^[a-z]+') AS command, lower(trim(q)) AS q FROM B WHERE type = 'do' AND q IS NOT NULL),
    r AS (SELECT o.command, o.q, row_number() OVER (PARTITION BY o.command ORDER BY p) AS r FROM o ANTI JOIN h ON h.command = o.command AND h.q = lower(o.q))"""


@query("command_questions", f"{_COMMAND_SQL} SELECT command, q FROM r WHERE r <= 10", "B")
def _(spark, sf):
    b = blocks(spark, sf).where("type = 'do'").select("q", F.regexp_extract("do", "^[a-z]+", 0).alias("command"))
    c = b.select("command", F.regexp_extract("command", f"^({'|'.join(_VERBS)})", 1).alias("verb")).distinct().where("verb <> '' and length(command) > length(verb)")
    synonyms = spark.createDataFrame(_VERB_ROWS, "verb string, ord int, synonym string")
    return ge.command_questions(c.select("command", "verb", F.expr("substring(command, length(verb) + 1)").alias("noun")), synonyms, b.where("q is not null"), 10)


@query(
    "bridged_passages",
    """WITH d AS (SELECT topic, text FROM documents WHERE topic IS NOT NULL AND text IS NOT NULL) SELECT 'prose' AS kind, NULL::VARCHAR AS q, NULL::VARCHAR AS a, text FROM d
    UNION ALL SELECT 'qa', 'Tell me about ' || topic || '.', text, NULL FROM d""",
)
def _(spark, sf):
    return ge.bridged(documents(spark, sf))


@query("earliest_values", "SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS priority, min(o_orderdate) AS since FROM orders GROUP BY o_custkey")
def _(spark, sf):
    """Of each customer's records the value of the earliest, as of a fact that later ones changed."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", F.struct("o_orderdate", "o_orderkey").alias("at"))
    e = ge.choose(o.select("o_custkey", F.col("o_orderpriority").alias("priority"), F.col("at.o_orderdate").alias("since"), "at"), "o_custkey", "at")
    return e.select("o_custkey", "priority", "since")


#: The seven checks of a corpus: each is a query, whose rows are what it finds.
_CHECKS = ("fabricated_commands", "wrong_facts", "answers_repeated_often", "near_duplicate_pairs", "filler_prefix", "thin_keywords", "prose_lengths")


@query("thin_keywords", """SELECT topic, w AS keyword, n FROM (SELECT topic, w, count(*) AS n FROM (SELECT unnest(keywords) AS w, topic FROM topic_rules) k JOIN (SELECT lower(a) AS a FROM answers WHERE a IS NOT NULL) a ON contains(a.a, w) WHERE regexp_matches(w, '^[a-z]+$') GROUP BY topic, w) WHERE n < 100""")
def _(spark, sf):
    """Plain keywords of topics that fewer than a hundred answers hold."""
    from grainmill.operators import rules as ru

    w = table(spark, sf, "topic_rules").select("topic", F.explode("keywords").alias("w")).where("rlike(w, '^[a-z]+$')")
    a = table(spark, sf, "answers").where("a is not null").select(F.lower("a").alias("a"))
    return ru.match(a, w, F.contains("a", F.col("w"))).groupBy("topic", F.col("w").alias("keyword")).agg(F.count("*").alias("n")).where("n < 100")


def _counted(name: str) -> str:
    return f"SELECT '{name}' AS \"check\", (SELECT count(*) FROM ({SQL[name]})) AS n_issues"


@query("seven_checks", f"SELECT *, n_issues = 0 AS passed FROM ({' UNION ALL '.join(_counted(c) for c in _CHECKS)})")
def _(spark, sf):
    """All seven in one result, each by the query of its name."""
    rows = [QUERIES[c](spark, sf).select(F.lit(c).alias("issue")) for c in _CHECKS]
    n = reduce(lambda x, y: x.unionByName(y), rows).groupBy("issue").agg(F.count("*").alias("n"))
    return ql.gates(n, list(_CHECKS))

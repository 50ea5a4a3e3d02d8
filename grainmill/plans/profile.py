"""Frequencies, histograms, n-grams, budgets, duplicates and contradictions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from grainmill.functions.text import (
    ACTION_RULES, NO_TOPIC, TOPIC_RULES, action_of, capitalize, capped_list, gate_tokens, list_join, occurrences, opener, ordinal, plural, rough_tokens, shortened, squeeze, strip, tokens, topic_of, typed_commands, unicode_words, with_article,
)
from grainmill.operators import profile as op
from grainmill.plans.base import answers, blocks, documents, pairs, query, table

_STRIP = r"regexp_replace({0}, '^[ \t\n\f\r]+|[ \t\n\f\r]+$', '', 'g')"
_WORDS = r"list_filter(string_split_regex({0}, '[ \t\n\f\r]+'), lambda w: w <> '')"


def S(c: str) -> str:
    return _STRIP.format(c)


def W(c: str) -> str:
    return _WORDS.format(c)


@query("answer_frequency_top", f"SELECT a, count(*) AS n, min(answer_id) AS first FROM A WHERE {S('a')} <> '' GROUP BY a ORDER BY n DESC, first LIMIT 30", "A")
def _(spark, sf):
    return op.top(op.frequency(answers(spark, sf), "a", "answer_id"), 30, F.desc("n"), F.asc("first"))


@query("answer_frequency_histogram", f", f AS (SELECT a, count(*) AS n FROM A WHERE {S('a')} <> '' GROUP BY a) SELECT n, count(*) AS values FROM f GROUP BY n", "A")
def _(spark, sf):
    return op.histogram(op.frequency(answers(spark, sf), "a"))


@query(
    "answer_frequency_summary",
    f""", f AS (SELECT a, count(*) AS n FROM A WHERE {S('a')} <> '' GROUP BY a)
    SELECT sum(n)::BIGINT AS total, count(*) AS distinct_values, max(n) AS most, min(n) AS least, (list_sort(list(n), 'DESC'))[count(*) // 2 + 1] AS median FROM f""",
    "A",
)
def _(spark, sf):
    return op.frequency_summary(op.frequency(answers(spark, sf), "a"))


@query(
    "answers_repeated_often",
    f"SELECT a, count(*) AS n, CASE WHEN count(*) >= 30 THEN 'very often' WHEN count(*) > 15 THEN 'often' ELSE 'several' END AS level FROM A WHERE {S('a')} <> '' GROUP BY a HAVING count(*) >= 4",
    "A",
)
def _(spark, sf):
    f = op.frequency(answers(spark, sf), "a").where("n >= 4")
    return f.withColumn("level", F.when(F.col("n") >= 30, "very often").when(F.col("n") > 15, "often").otherwise("several"))


@query(
    "word_budget_top",
    f""", f AS (SELECT a, count(*) AS n, len({W('a')}) AS words FROM A WHERE {S('a')} <> '' GROUP BY a)
    SELECT a, n, words, n * words AS budget FROM f ORDER BY budget DESC, n DESC, words DESC, a DESC LIMIT 30""",
    "A",
)
def _(spark, sf):
    return op.top(op.word_budget(op.frequency(answers(spark, sf), "a"), "a"), 30, F.desc("budget"), F.desc("n"), F.desc("words"), F.desc("a"))


@query("word_budget_total", f"SELECT sum(len({W('a')}))::BIGINT AS words, count(*) AS answers FROM A WHERE {S('a')} <> ''", "A")
def _(spark, sf):
    return answers(spark, sf).where(strip("a") != "").agg(F.sum(F.size(tokens("a"))).alias("words"), F.count("*").alias("answers"))


@query(
    "length_stats",
    f""", t AS (SELECT type, len({W("coalesce(a, \"do\", text)")}) AS w FROM B WHERE coalesce(a, "do", text) IS NOT NULL)
    SELECT type, count(*) AS n, avg(w) AS avg_words, min(w) AS min_words, max(w) AS max_words FROM t GROUP BY type""",
    "B",
)
def _(spark, sf):
    b = blocks(spark, sf).withColumn("body", F.coalesce("a", "do", "text"))
    return op.length_stats(b, "type", "body")


@query(
    "opener_top",
    f"SELECT array_to_string(list_slice({W('a')}, 1, 4), ' ') AS opener, count(*) AS n FROM A WHERE {S('a')} <> '' GROUP BY 1 ORDER BY n DESC, opener LIMIT 20",
    "A",
)
def _(spark, sf):
    o = answers(spark, sf).where(strip("a") != "").groupBy(opener("a").alias("opener")).agg(F.count("*").alias("n"))
    return op.top(o, 20, F.desc("n"), F.asc("opener"))


def _grams(name: str, size: int, k: int) -> None:
    parts = " || ' ' || ".join(f"w[i + {d}]" if d else "w[i]" for d in range(size))
    sql = f""", x AS (SELECT {W('lower(a)')} AS w FROM A WHERE a IS NOT NULL),
    g AS (SELECT {parts} AS ngram FROM (SELECT w, unnest(range(1, len(w) - {size - 2})) AS i FROM x WHERE len(w) >= {size}))
    SELECT ngram, count(*) AS n FROM g GROUP BY ngram ORDER BY n DESC, ngram LIMIT {k}"""

    @query(name, sql, "A")
    def _(spark, sf):
        return op.top(op.ngram_frequency(answers(spark, sf), "a", size), k, F.desc("n"), F.asc("ngram"))


_grams("trigram_top", 3, 30)
_grams("fourgram_top", 4, 25)


@query(
    "block_shares",
    """SELECT count(*) AS n_blocks, count(*) FILTER (type = 'qa') AS n_qa, count(*) FILTER (type = 'do') AS n_do, count(*) FILTER (type = 'prose') AS n_prose,
    count(*) FILTER (a LIKE 'Type %') AS n_type_led, 100 * count(*) FILTER (a LIKE 'Type %') // nullif(count(a), 0) AS type_led_percent,
    count(*) FILTER (type = 'prose') / nullif(count(*) FILTER (type IN ('qa', 'do')), 0) AS prose_per_pair,
    count(*) FILTER (type LIKE 'orphan%') AS n_orphans FROM B""",
    "B",
)
def _(spark, sf):
    t = F.col("type")
    led = F.count_if(F.col("a").startswith("Type "))
    return blocks(spark, sf).agg(
        F.count("*").alias("n_blocks"),
        F.count_if(t == "qa").alias("n_qa"),
        F.count_if(t == "do").alias("n_do"),
        F.count_if(t == "prose").alias("n_prose"),
        led.alias("n_type_led"),
        F.floor(100 * led / F.nullif(F.count("a"), F.lit(0))).alias("type_led_percent"),
        (F.count_if(t == "prose") / F.nullif(F.count_if(t.isin("qa", "do")), F.lit(0))).alias("prose_per_pair"),
        F.count_if(t.startswith("orphan")).alias("n_orphans"),
    )


_NORM = "lower(" + S("{0}") + ")"


@query(
    "duplicate_pairs",
    f"""SELECT prefix, {_NORM.format('q')} AS q, {_NORM.format('a')} AS response, count(*) AS n, list_sort(list(DISTINCT line_no)) AS lines, count(*) - 1 AS surplus
    FROM P WHERE q IS NOT NULL AND {S('a')} <> '' GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "P",
)
def _(spark, sf):
    p = pairs(spark, sf).where("q is not null").select("prefix", F.lower(strip("q")).alias("q"), F.lower(strip("a")).alias("response"), "line_no").where("response <> ''")
    g = p.groupBy("prefix", "q", "response").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("line_no")).alias("lines"))
    return g.where("n > 1").withColumn("surplus", F.col("n") - 1)


@query(
    "contradictions",
    f"""SELECT {_NORM.format('q')} AS q, count(DISTINCT {_NORM.format('a')}) AS n_answers, count(*) AS n FROM (SELECT q, a FROM B WHERE type = 'qa' UNION ALL SELECT q, a FROM (SELECT DISTINCT pair_id, path, line_no, q, a, prefix FROM pairs))
    WHERE {S('q')} <> '' AND a IS NOT NULL GROUP BY 1 HAVING count(DISTINCT {_NORM.format('a')}) > 1""",
    "B",
)
def _(spark, sf):
    both = blocks(spark, sf).where("type = 'qa'").select("q", "a").unionByName(pairs(spark, sf).select("q", "a"))
    b = both.where(F.col("a").isNotNull() & (strip("q") != ""))
    g = b.groupBy(F.lower(strip("q")).alias("q"), F.lower(strip("a")).alias("a")).agg(F.count("*").alias("n"))
    return g.groupBy("q").agg(F.count("*").alias("n_answers"), F.sum("n").alias("n")).where("n_answers > 1")


@query(
    "shared_answers",
    f"SELECT {S('a')} AS a, count(DISTINCT q) AS n_questions, count(*) AS n FROM B WHERE type = 'qa' AND {S('a')} <> '' GROUP BY 1 HAVING count(DISTINCT q) >= 4",
    "B",
)
def _(spark, sf):
    b = blocks(spark, sf).where("type = 'qa'").withColumn("a", strip("a")).where("a <> ''")
    g = b.groupBy("a", "q").agg(F.count("*").alias("n"))  # salts the hot answers by question
    return g.groupBy("a").agg(F.count("q").alias("n_questions"), F.sum("n").alias("n")).where("n_questions >= 4")


@query(
    "command_distribution",
    f"""SELECT lower({W('"do"')}[1]) AS command, count(*) AS n, CASE WHEN count(*) < 3 THEN 'thin' ELSE 'ok' END AS level
    FROM B WHERE type = 'do' AND {S('"do"')} <> '' GROUP BY 1""",
    "B",
)
def _(spark, sf):
    c = blocks(spark, sf).where("type = 'do'").where(strip("do") != "").groupBy(F.lower(tokens("do")[0]).alias("command")).agg(F.count("*").alias("n"))
    return c.withColumn("level", F.when(F.col("n") < 3, "thin").otherwise("ok"))


@query(
    "command_references",
    r"""SELECT command, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(a), '(?:^|[^a-z0-9_])(?:type|run|use) ([a-z][a-z0-9_]+)', 1)) AS command FROM B WHERE type = 'qa')
    WHERE command NOT IN ('the', 'a', 'an', 'if') GROUP BY command""",
    "B",
)
def _(spark, sf):
    found = F.regexp_extract_all(F.lower("a"), F.lit("(?:^|[^a-z0-9_])(?:type|run|use) ([a-z][a-z0-9_]+)"), F.lit(1))
    c = blocks(spark, sf).where("type = 'qa'").select(F.explode(found).alias("command")).where("command not in ('the', 'a', 'an', 'if')")
    return c.groupBy("command").agg(F.count("*").alias("n"))


@query(
    "vocabulary_counts",
    "SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents) WHERE NOT regexp_matches(word, '^[0-9]+$') AND length(word) >= 3 GROUP BY word HAVING count(*) >= 2",
)
def _(spark, sf):
    w = documents(spark, sf).select(F.explode(gate_tokens("text")).alias("word")).where("length(word) >= 3 and not rlike(word, '^[0-9]+$')")
    return w.groupBy("word").agg(F.count("*").alias("n")).where("n >= 2")


@query(
    "capitalized_terms",
    "SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '(?:^|[^A-Za-z0-9_])([A-Z][a-z]{2,})', 1)) AS term FROM documents) GROUP BY term HAVING count(*) >= 5",
)
def _(spark, sf):
    t = documents(spark, sf).select(F.explode(F.regexp_extract_all("text", F.lit("(?:^|[^A-Za-z0-9_])([A-Z][a-z]{2,})"), F.lit(1))).alias("term"))
    return t.groupBy("term").agg(F.count("*").alias("n")).where("n >= 5")


@query(
    "first_write_wins",
    f""", x AS (SELECT {S('q')} AS q, {S('a')} AS a, pair_id FROM P WHERE {S('q')} <> '' AND {S('a')} <> ''),
    f AS (SELECT q, arg_min(a, pair_id) AS a FROM x GROUP BY q)
    SELECT q, f.a, count(*) AS n, count(*) FILTER (x.a <> f.a) AS conflicts FROM x JOIN f USING (q) GROUP BY q, f.a""",
    "P",
)
def _(spark, sf):
    x = pairs(spark, sf).select(strip("q").alias("q"), strip("a").alias("a"), "pair_id").where("q <> '' and a <> ''")
    # by (q, a) first: a question asked a million times is then a few rows
    g = x.groupBy("q", "a").agg(F.count("*").alias("n"), F.min("pair_id").alias("first"))
    one = g.groupBy("q").agg(F.min_by(F.struct("a", "n"), "first").alias("w"), F.sum("n").alias("n"))
    return one.select("q", F.col("w.a").alias("a"), "n", (F.col("n") - F.col("w.n")).alias("conflicts"))


@query("pair_dedupe", "SELECT q, a, min(pair_id) AS first, count(*) AS n FROM P GROUP BY q, a", "P")
def _(spark, sf):
    return pairs(spark, sf).groupBy("q", "a").agg(F.min("pair_id").alias("first"), F.count("*").alias("n"))


@query("answer_question_groups", "SELECT prefix, a, count(DISTINCT q) AS n_questions, min(pair_id) AS first FROM P WHERE a IS NOT NULL GROUP BY prefix, a", "P")
def _(spark, sf):
    g = pairs(spark, sf).where("a is not null").groupBy("prefix", "a", "q").agg(F.min("pair_id").alias("first"))
    return g.groupBy("prefix", "a").agg(F.count("q").alias("n_questions"), F.min("first").alias("first"))


@query("answer_questions", "SELECT prefix, a, q, count(*) AS n FROM P WHERE a IS NOT NULL AND q IS NOT NULL GROUP BY prefix, a, q", "P")
def _(spark, sf):
    """The questions of each answer, one row each: an answer with a third of all questions is no single row."""
    return pairs(spark, sf).where("a is not null and q is not null").groupBy("prefix", "a", "q").agg(F.count("*").alias("n"))


@query("group_size_check", "SELECT n_rows, count(*) AS n_groups FROM (SELECT prefix, a, count(*) AS n_rows FROM P WHERE a IS NOT NULL GROUP BY prefix, a HAVING count(*) <> 5) GROUP BY n_rows", "P")
def _(spark, sf):
    g = pairs(spark, sf).where("a is not null").groupBy("prefix", "a").agg(F.count("*").alias("n_rows")).where("n_rows <> 5")
    return g.groupBy("n_rows").agg(F.count("*").alias("n_groups"))


# An own list: words that say nothing about what is asked.
_STOP = sorted("about and are can could did does for from has have how its may me my not our should tell that the there these they this those was were what when where which who why will with would you your".split())


@query(
    "top_question_word",
    f""", w AS (SELECT a, unnest(regexp_extract_all(lower(q), '[\\p{{L}}\\p{{N}}]+')) AS word FROM P WHERE a IS NOT NULL),
    c AS (SELECT a, word, count(*) AS n FROM w WHERE length(word) > 2 AND word NOT IN ({", ".join(f"'{x}'" for x in _STOP)}) GROUP BY a, word)
    SELECT a, word, n FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY n DESC, word) AS r FROM c) WHERE r = 1""",
    "P",
)
def _(spark, sf):
    w = pairs(spark, sf).where("a is not null").select("a", F.explode(unicode_words("q")).alias("word")).where(F.length("word") > 2)
    c = w.where(~F.col("word").isin(_STOP)).groupBy("a", "word").agg(F.count("*").alias("n"))
    return c.groupBy("a").agg(F.min_by(F.struct("word", "n"), F.struct(F.negative("n"), F.col("word"))).alias("w")).select("a", "w.word", "w.n")


@query(
    "phrase_counts",
    """SELECT sum((length(t) - length(replace(t, 'lamp', ''))) // 4)::BIGINT AS lamp, sum((length(t) - length(replace(t, 'the card', ''))) // 8)::BIGINT AS the_card
    FROM (SELECT lower(coalesce(text, '')) AS t FROM documents)""",
)
def _(spark, sf):
    t = F.lower(F.coalesce("text", F.lit("")))
    return documents(spark, sf).agg(F.sum(occurrences(t, F.lit("lamp"))).alias("lamp"), F.sum(occurrences(t, F.lit("the card"))).alias("the_card"))


@query(
    "tensor_stats",
    """, x AS (SELECT label, unnest(embedding)::DOUBLE AS x FROM embeddings),
    s AS (SELECT label, count(x) AS n, min(x) AS lo, max(x) AS hi, avg(x) AS mean, stddev_samp(x) AS std, count(*) FILTER (isnan(x)) AS n_nan, count(*) FILTER (x = 0) / count(x) AS zero_share FROM x GROUP BY label)
    SELECT label, n, lo, hi, round(mean, 6) AS mean, round(std, 6) AS std, n_nan, zero_share, n_nan > 0 OR std < 1e-6 OR zero_share > 0.9 AS degenerate FROM s""".replace(", x AS", "WITH x AS", 1),
)
def _(spark, sf):
    s = op.numeric_stats(table(spark, sf, "embeddings"), "label", "embedding")
    return s.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@query(
    "series_summary",
    """SELECT user_id, arg_min(value, (ts, event_id)) AS first, arg_max(value, (ts, event_id)) AS last, min(value) AS least, min((value, ts)::STRUCT(a DOUBLE, b TIMESTAMP)).b AS at_least
    FROM events GROUP BY user_id""",
)
def _(spark, sf):
    return op.series_summary(table(spark, sf, "events"), "user_id", ["ts", "event_id"], "value")


@query(
    "block_diagnostics",
    """SELECT min(n) AS shortest, max(n) AS longest, avg(n) AS mean, count(*) FILTER (q) AS has_q, count(*) FILTER (a) AS has_a, count(*) FILTER (q AND a) AS has_both, count(*) FILTER (q AND NOT a) AS lacks_a
    FROM (SELECT greatest(1, length(text) // 4) AS n, contains(text, 'Q: ') AS q, contains(text, 'A: ') AS a FROM documents WHERE text IS NOT NULL)""",
)
def _(spark, sf):
    d = documents(spark, sf).where("text is not null").select(rough_tokens("text").alias("n"), F.contains("text", F.lit("Q: ")).alias("q"), F.contains("text", F.lit("A: ")).alias("a"))
    return d.agg(
        F.min("n").alias("shortest"),
        F.max("n").alias("longest"),
        F.avg("n").alias("mean"),
        F.count_if("q").alias("has_q"),
        F.count_if("a").alias("has_a"),
        F.count_if(F.col("q") & F.col("a")).alias("has_both"),
        F.count_if(F.col("q") & ~F.col("a")).alias("lacks_a"),
    )


@query(
    "reverse_lookup",
    "SELECT r_name, count(*) AS n, array_to_string(list_sort(list(n_name)), ', ') AS names FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name",
)
def _(spark, sf):
    j = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("n_name")), ", ").alias("names"))


@query(
    "region_sentences",
    """, g AS (SELECT r_name, list_sort(list(n_name)) AS names FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)
    SELECT upper(r_name[1]) || lower(r_name[2:]) AS region, CASE WHEN len(names) = 1 THEN names[1] WHEN len(names) = 2 THEN names[1] || ' and ' || names[2]
    ELSE array_to_string(names[1:len(names) - 1], ', ') || ', and ' || names[len(names)] END AS sentence FROM g""".replace(", g AS", "WITH g AS", 1),
)
def _(spark, sf):
    j = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    g = j.groupBy("r_name").agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    return g.select(capitalize("r_name").alias("region"), list_join(F.col("names")).alias("sentence"))


@query(
    "superlatives",
    """SELECT p_brand, max(p_size) AS largest, arg_max(p_partkey, (p_size, -p_partkey)) AS largest_part, round(max(p_retailprice), 2) AS dearest, arg_max(p_partkey, (p_retailprice, -p_partkey)) AS dearest_part
    FROM part GROUP BY p_brand""",
)
def _(spark, sf):
    p = table(spark, sf, "part")
    key = F.negative("p_partkey").alias("k")
    return p.groupBy("p_brand").agg(
        F.max("p_size").alias("largest"),
        F.max_by("p_partkey", F.struct(F.col("p_size"), key)).alias("largest_part"),
        F.round(F.max("p_retailprice"), 2).alias("dearest"),
        F.max_by("p_partkey", F.struct(F.col("p_retailprice"), key)).alias("dearest_part"),
    )


@query("squeezed_answers", r"SELECT trim(regexp_replace(a, '[ \t\n\f\r]+', ' ', 'g'), ' ') AS a, count(*) AS n, count(DISTINCT a) AS forms FROM (SELECT q AS a FROM B UNION ALL SELECT a FROM B UNION ALL SELECT text FROM B) WHERE a IS NOT NULL GROUP BY 1 HAVING count(DISTINCT a) > 1", "B")
def _(spark, sf):
    """Questions, answers and prose of the blocks that differ in white space only."""
    x = blocks(spark, sf).select(F.explode(F.array("q", "a", "text")).alias("a"))
    g = x.where("a is not null").groupBy("a").agg(F.count("*").alias("n"))
    return g.groupBy(squeeze("a").alias("a")).agg(F.sum("n").alias("n"), F.count("*").alias("forms")).where("forms > 1")


_FIRST = lambda pattern: f"nullif(regexp_extract(a, '{pattern}', 1), '')"
_TOPIC = f"""coalesce({", ".join(_FIRST(x) for x, skip in TOPIC_RULES if not skip)},
    list_filter(regexp_extract_all(a, '{TOPIC_RULES[-1][0]}', 1), lambda w: NOT list_contains([{", ".join(f"'{w}'" for w in sorted(NO_TOPIC))}], w))[1])"""
_ACTION = f"lower(coalesce({', '.join(_FIRST(x) for x, _ in ACTION_RULES)}, {_TOPIC}))"


@query("answer_topics", f"SELECT answer_id, {_TOPIC} AS topic, {_ACTION} AS action FROM A WHERE a IS NOT NULL", "A")
def _(spark, sf):
    return answers(spark, sf).where("a is not null").select("answer_id", topic_of("a").alias("topic"), action_of("a").alias("action"))


@query("typed_commands", """, w AS (SELECT regexp_replace(unnest(regexp_extract_all(a, '(?i)\\btype\\s+([^ \t\n\f\r]+)', 1)), '[.,;:]+$', '') AS command FROM B WHERE type = 'qa')
 SELECT command, count(*) AS n FROM w WHERE command <> '' AND lower(command) NOT IN ('the', 'if', 'a', 'an') GROUP BY command""", "B")
def _(spark, sf):
    c = blocks(spark, sf).where("type = 'qa'").select(F.explode(typed_commands("a")).alias("command"))
    return c.groupBy("command").agg(F.count("*").alias("n"))


@query(
    "display_lines",
    """WITH r AS (SELECT n_name, r_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS k FROM nation JOIN region ON n_regionkey = r_regionkey),
    o AS (SELECT * FROM (VALUES (1, 'first'), (2, 'second'), (3, 'third'), (4, 'fourth'), (5, 'fifth'), (6, 'sixth'), (7, 'seventh'), (8, 'eighth'), (9, 'ninth'), (10, 'tenth')) t(k, word))
    SELECT n_name, word AS rank, CASE WHEN regexp_matches(n_name, '^[AEIOUaeiou]') THEN 'an ' ELSE 'a ' END || n_name AS one, n_name || CASE WHEN regexp_matches(n_name, '[sS]$') THEN 'es' ELSE 's' END AS many FROM r JOIN o USING (k)""",
)
def _(spark, sf):
    """Nations in words: their rank in the region, with an article, and in the plural."""
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_name"))
    return n.withColumn("k", k).select("n_name", ordinal("k").alias("rank"), with_article("n_name").alias("one"), plural("n_name").alias("many"))


@query("shortened_answers", "SELECT answer_id, CASE WHEN length(a) > 60 THEN substr(a, 1, 60) || '...' ELSE a END AS shown FROM A WHERE a IS NOT NULL", "A")
def _(spark, sf):
    return answers(spark, sf).where("a is not null").select("answer_id", shortened("a").alias("shown"))


@query(
    "region_suppliers",
    """WITH l AS (SELECT n_name, list_sort(list(s_name)) AS s FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name)
    SELECT n_name, CASE WHEN len(s) > 6 THEN array_to_string(s[1:6], ', ') || ', among others' WHEN len(s) = 1 THEN s[1] WHEN len(s) = 2 THEN s[1] || ' and ' || s[2] ELSE array_to_string(s[1:len(s) - 1], ', ') || ', and ' || s[len(s)] END AS suppliers FROM l""",
)
def _(spark, sf):
    j = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(capped_list(F.array_sort(F.collect_list("s_name"))).alias("suppliers"))


@query("word_top", ", w AS (SELECT unnest(regexp_extract_all(lower(a), '[a-z0-9]+')) AS word FROM A) SELECT word, count(*) AS n FROM w GROUP BY word ORDER BY n DESC, word DESC LIMIT 25", "A")
def _(spark, sf):
    w = answers(spark, sf).select(F.explode(gate_tokens("a")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return op.top(w, 25, F.desc("n"), F.desc("word"))


@query("topics_ranked", "SELECT topic, n, row_number() OVER (ORDER BY n DESC, topic)::BIGINT AS place, n < 20 AS thin FROM (SELECT topic, count(*) AS n FROM documents WHERE topic IS NOT NULL GROUP BY topic)")
def _(spark, sf):
    """Topics by falling number of documents; a topic with fewer than twenty is thin."""
    n = documents(spark, sf).where("topic is not null").groupBy("topic").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.orderBy(F.desc("n"), "topic")).cast("long")  # one row for each topic
    return n.select("topic", "n", place.alias("place"), (F.col("n") < 20).alias("thin"))

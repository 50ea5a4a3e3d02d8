"""Rule tables, cross references, vocabularies and sets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from grainmill.functions.text import occurrences, printable_runs, snippet, strip
from grainmill.operators import ordered as od
from grainmill.operators import rules as ru
from grainmill.operators import vocab as vo
from grainmill.plans.base import answers, blocks, documents, pairs, query, table
from grainmill.plans.profile import S

_COMMANDS = """, known AS (SELECT DISTINCT lower(regexp_extract("do", '^[a-zA-Z]+')) AS command FROM B WHERE type = 'do' AND path = 'corpora/help_core.txt' AND regexp_matches("do", '^[a-zA-Z]+')),
 used AS (SELECT DISTINCT unnest(regexp_extract_all(lower(a), '(?:^|[^a-z0-9_])(?:type|run|use) ([a-z][a-z0-9_]+)', 1)) AS command FROM B WHERE type = 'qa')"""


def _known(spark, sf):
    c = blocks(spark, sf).where("type = 'do' and path = 'corpora/help_core.txt'")
    return c.select(F.lower(F.regexp_extract("do", "^[a-zA-Z]+", 0)).alias("command")).where("command <> ''").distinct()


def _used(spark, sf):
    found = F.regexp_extract_all(F.lower("a"), F.lit("(?:^|[^a-z0-9_])(?:type|run|use) ([a-z][a-z0-9_]+)"), F.lit(1))
    return blocks(spark, sf).where("type = 'qa'").select(F.explode(found).alias("command")).distinct()


@query("fabricated_commands", f"{_COMMANDS} SELECT command FROM used WHERE command NOT IN (SELECT command FROM known)", "B")
def _(spark, sf):
    return _used(spark, sf).join(_known(spark, sf), "command", "left_anti")


@query("coverage_gaps", f"{_COMMANDS} SELECT command FROM known WHERE command NOT IN (SELECT command FROM used) AND (command LIKE 'open%' OR command LIKE 'close%' OR command LIKE '%lamp')", "B")
def _(spark, sf):
    c = F.col("command")
    return _known(spark, sf).join(_used(spark, sf), "command", "left_anti").where(c.startswith("open") | c.startswith("close") | c.endswith("lamp"))


@query("command_flags", f"{_COMMANDS} SELECT command, command IN (SELECT command FROM used) AS in_training FROM known", "B")
def _(spark, sf):
    u = _used(spark, sf).withColumn("hit", F.lit(True))
    return _known(spark, sf).join(u, "command", "left").select("command", F.col("hit").isNotNull().alias("in_training"))


@query("unknown_do_commands", f"""{_COMMANDS} SELECT block_id, lower(string_split("do", ' ')[1]) AS command FROM B WHERE type = 'do' AND {S('"do"')} <> '' AND lower(string_split("do", ' ')[1]) NOT IN (SELECT command FROM known)""", "B")
def _(spark, sf):
    d = blocks(spark, sf).where("type = 'do'").where(strip("do") != "").select("block_id", F.lower(F.split("do", " ")[0]).alias("command"))
    return d.join(_known(spark, sf), "command", "left_anti").select("block_id", "command")


_TERMS = [("lamp", 1), ("damper", 2), ("fuse box", 3), ("Kiln", 4)]
_TERMS_SQL = "(VALUES " + ", ".join(f"('{t}', {i})" for t, i in _TERMS) + ") t(term, ord)"


def _terms(spark):
    return spark.createDataFrame(_TERMS, "term string, ord int")


@query("bad_terms", f"SELECT answer_id, term FROM A, {_TERMS_SQL} WHERE contains(lower(a), lower(term))", "A")
def _(spark, sf):
    return ru.match(answers(spark, sf), _terms(spark), ru.contains("a", "term")).select("answer_id", "term")


_OLD = [(1, "steer", "guide", True), (2, "Type load", "Run load", False), (3, "fuse", "breaker", True), (4, "C++", "C", True)]


@query(
    "deprecated_hits",
    """, r AS (SELECT * FROM (VALUES (1, 'steer', 'guide', true, '(^|[^A-Za-z0-9_])steer($|[^A-Za-z0-9_])'), (2, 'Type load', 'Run load', false, ''), (3, 'fuse', 'breaker', true, '(^|[^A-Za-z0-9_])fuse($|[^A-Za-z0-9_])'),
    (4, 'C++', 'C', true, '(^|[^A-Za-z0-9_])C\\+\\+($|[^A-Za-z0-9_])')) t(ord, bad, instead, word, re))
    SELECT answer_id, bad, instead FROM A, r WHERE CASE WHEN word THEN regexp_matches(a, re) ELSE contains(a, bad) END""",
    "A",
)
def _(spark, sf):
    r = spark.createDataFrame(_OLD, "ord int, bad string, instead string, word boolean")
    return ru.match(answers(spark, sf), r, ru.term_or_word("a", "bad", "word")).select("answer_id", "bad", "instead")


@query(
    "wrong_facts",
    """SELECT answer_id, rule, pattern FROM A, (VALUES ('units', 'hert[sz]'), ('units', 'milimet'), ('spelling', 'seld?om'), ('phrase', 'followed by (the|a) ')) t(rule, pattern) WHERE regexp_matches(a, pattern, 'i')""",
    "A",
)
def _(spark, sf):
    r = spark.createDataFrame([("units", "hert[sz]"), ("units", "milimet"), ("spelling", "seld?om"), ("phrase", "followed by (the|a) ")], "rule string, pattern string")
    return ru.match(answers(spark, sf), r, F.expr("rlike(a, concat('(?i)', pattern))")).select("answer_id", "rule", "pattern")


_TOPICS = """, r AS (SELECT topic, array_to_string(keywords, '|') AS re FROM topic_rules WHERE len(keywords) > 0),
 h AS (SELECT DISTINCT pair_id, topic FROM P, r WHERE regexp_matches(coalesce(q, '') || ' ' || coalesce(a, ''), re, 'i'))"""


def _hits(spark, sf):
    both = F.concat(F.coalesce("q", F.lit("")), F.lit(" "), F.coalesce("a", F.lit("")))
    return ru.topics(pairs(spark, sf), ["pair_id"], both, table(spark, sf, "topic_rules"))


@query("topic_coverage", f"{_TOPICS} SELECT topic, count(*) AS n, CASE WHEN count(*) < 20 THEN 'THIN' ELSE 'ok' END AS level FROM h GROUP BY topic", "P")
def _(spark, sf):
    c = _hits(spark, sf).groupBy("topic").agg(F.count("*").alias("n"))
    return c.withColumn("level", F.when(F.col("n") < 20, "THIN").otherwise("ok"))


@query("topic_missing", f"{_TOPICS} SELECT pair_id FROM P WHERE pair_id NOT IN (SELECT pair_id FROM h)", "P")
def _(spark, sf):
    return pairs(spark, sf).select("pair_id").join(_hits(spark, sf).select("pair_id"), "pair_id", "left_anti")


@query("topic_prose", """, r AS (SELECT topic, array_to_string(keywords, '|') AS re FROM topic_rules WHERE len(keywords) > 0)
 SELECT topic, max(CASE WHEN regexp_matches(text, re, 'i') THEN 1 ELSE 0 END) = 1 AS covered FROM r LEFT JOIN (SELECT text FROM B WHERE type = 'prose') ON true GROUP BY topic""", "B")
def _(spark, sf):
    rules = table(spark, sf, "topic_rules")
    hit = ru.topics(blocks(spark, sf).where("type = 'prose'"), ["block_id"], F.col("text"), rules).select("topic").distinct().withColumn("hit", F.lit(True))
    return rules.where(F.size("keywords") > 0).select("topic").distinct().join(hit, "topic", "left").select("topic", F.col("hit").isNotNull().alias("covered"))


_FILLERS = ["Could you ", "Can you ", "Tell me about ", "Could you tell me ", "Help me ", "Please ", "How do I "]


@query(
    "filler_prefix",
    f""", r AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{p}')" for i, p in enumerate(_FILLERS))}) t(ord, prefix))
    SELECT pair_id, q, arg_min(r.prefix, ord) AS prefix FROM P, r WHERE starts_with(lower(q), lower(r.prefix)) GROUP BY pair_id, q""",
    "P",
)
def _(spark, sf):
    r = spark.createDataFrame(list(enumerate(_FILLERS)), "ord int, prefix string")
    return ru.first_prefix(pairs(spark, sf), ["pair_id"], "q", r)


_TOKENS = ["loadgrid", "the", "zebra crossing", "mutebelt", "quaternion", "lamp"]


@query("wasted_tokens", f"SELECT token FROM (VALUES {', '.join(f'({chr(39)}{t}{chr(39)})' for t in _TOKENS)}) t(token) WHERE NOT EXISTS (SELECT 1 FROM documents WHERE contains(text, token))")
def _(spark, sf):
    t = spark.createDataFrame([(x,) for x in _TOKENS], "token string")
    found = ru.match(documents(spark, sf).select("text"), t, F.contains("text", F.col("token"))).select("token").distinct()
    return t.join(found, "token", "left_anti")


@query(
    "domain_fingerprint",
    """, w AS (SELECT topic, word FROM (SELECT topic, unnest(keywords) AS word FROM topic_rules) WHERE regexp_matches(word, '^[a-z]+$'))
    SELECT topic, sum((length(t) - length(replace(t, word, ''))) // length(word))::BIGINT AS n FROM (SELECT lower(text) AS t FROM documents WHERE text IS NOT NULL), w GROUP BY topic""".replace(", w AS", "WITH w AS", 1),
)
def _(spark, sf):
    w = table(spark, sf, "topic_rules").select("topic", F.explode("keywords").alias("word")).where("rlike(word, '^[a-z]+$')")
    hits = ru.match(documents(spark, sf).where("text is not null").select(F.lower("text").alias("t")), w, F.contains("t", F.col("word")))
    n = hits.groupBy("topic").agg(F.sum(occurrences("t", F.col("word"))).alias("n"))
    return w.select("topic").distinct().join(n, "topic", "left").select("topic", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "forbidden_hits",
    """, w AS (SELECT * FROM (VALUES ('lumens'), ('Restart'), ('forbid')) t(word)), d AS (SELECT doc_id, text, word, strpos(lower(text), lower(word)) AS pos FROM documents, w)
    SELECT doc_id, word, trim(regexp_replace(substr(text, greatest(1, pos - 30), pos + length(word) + 30 - greatest(1, pos - 30)), '[\\r\\n]', ' ', 'g'), ' ') AS snippet FROM d WHERE pos > 0""".replace(", w AS", "WITH w AS", 1),
)
def _(spark, sf):
    w = spark.createDataFrame([("lumens",), ("Restart",), ("forbid",)], "word string")
    hits = ru.match(documents(spark, sf).select("doc_id", "text"), w, ru.contains("text", "word"))
    return hits.select("doc_id", "word", snippet("text", F.col("word")).alias("snippet"))


@query(
    "binary_hits",
    """WITH w AS (SELECT DISTINCT word FROM (SELECT unnest(keywords) AS word FROM topic_rules) WHERE regexp_matches(word, '^[a-z]+$')), r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[ -~]{3,}')) AS run FROM documents)
    SELECT doc_id, word, count(*) AS n FROM r, w WHERE contains(lower(run), word) GROUP BY doc_id, word""",
)
def _(spark, sf):
    """The documents as bytes: runs of printable characters that hold a word of the rules."""
    w = table(spark, sf, "topic_rules").select(F.explode("keywords").alias("word")).where("rlike(word, '^[a-z]+$')").distinct()
    runs = documents(spark, sf).select("doc_id", F.explode(printable_runs(F.encode("text", "UTF-8"))).alias("run"))
    return ru.match(runs, w, ru.contains("run", "word")).groupBy("doc_id", "word").agg(F.count("*").alias("n"))


@query(
    "output_hits",
    """WITH w AS (SELECT DISTINCT word FROM (SELECT unnest(keywords) AS word FROM topic_rules) WHERE regexp_matches(word, '^[a-z]+$')),
    s AS (SELECT path, line_no, line, sum(CASE WHEN regexp_matches(line, 'llm (?:ask|generate) ".*"') THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY line_no) AS session FROM session_log)
    SELECT path, session::BIGINT AS session, count(*) AS n_lines, count(DISTINCT word) AS n_words FROM s, w WHERE session > 0 AND NOT regexp_matches(line, 'llm (?:ask|generate) ".*"') AND NOT line LIKE '[LLM]%' AND contains(lower(line), word) GROUP BY path, session""",
)
def _(spark, sf):
    """What a model said in each session, held against the words of the rules."""
    w = table(spark, sf, "topic_rules").select(F.explode("keywords").alias("word")).where("rlike(word, '^[a-z]+$')").distinct()
    s = od.sessions(table(spark, sf, "session_log").select("path", "line_no", "line"))
    said = s.where(~F.col("line").rlike('llm (?:ask|generate) ".*"') & ~F.col("line").startswith("[LLM]"))
    return ru.match(said, w, ru.contains("line", "word")).groupBy("path", "session").agg(F.count("*").alias("n_lines"), F.countDistinct("word").alias("n_words"))


@query(
    "forbidden_list",
    """WITH a AS (SELECT lower(word) AS word, k * 1000 + i AS ord FROM (SELECT row_number() OVER (ORDER BY topic) AS k, unnest(keywords) AS word, generate_subscripts(keywords, 1) AS i FROM topic_rules) WHERE word <> ''
      UNION ALL SELECT lower(n_name), 1000000 + n_nationkey FROM nation UNION ALL SELECT lower(r_name), 2000000 + r_regionkey FROM region)
    SELECT word, min(ord)::BIGINT AS first FROM a GROUP BY word""",
)
def _(spark, sf):
    """The words of all presets in order, then the user's own."""
    k = F.row_number().over(Window.orderBy("topic"))  # a written list of rules
    presets = table(spark, sf, "topic_rules").withColumn("k", k).select("k", F.posexplode("keywords").alias("i", "word")).where("word <> ''")
    own = table(spark, sf, "nation").select((F.lit(1_000_000) + F.col("n_nationkey")).cast("long").alias("ord"), F.col("n_name").alias("word"))
    more = table(spark, sf, "region").select((F.lit(2_000_000) + F.col("r_regionkey")).cast("long").alias("ord"), F.col("r_name").alias("word"))
    every = presets.select((F.col("k") * 1000 + F.col("i") + 1).cast("long").alias("ord"), "word").unionByName(own).unionByName(more)
    return vo.ordered_distinct(every.withColumn("word", F.lower("word")), "word", "ord")


_STOPS = "the and for with that this from are was has have each every any our your its not but one two".split()
_VOCAB = f""", c AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents) GROUP BY word),
 k AS (SELECT word, n FROM c WHERE n >= 2 AND length(word) >= 3 AND NOT regexp_matches(word, '^[0-9]+$') AND word NOT IN ({", ".join(f"'{x}'" for x in _STOPS)})),
 f AS (SELECT word, coalesce(n, 1) AS n FROM (VALUES ('loadgrid'), ('quaternion'), ('the'), ('ox')) t(word) LEFT JOIN c USING (word) WHERE length(word) >= 3 AND word NOT IN (SELECT word FROM k))"""


@query("domain_vocab", (f"{_VOCAB} SELECT word, n FROM (SELECT * FROM k UNION ALL SELECT * FROM f) ORDER BY n DESC, word LIMIT 600").replace(", c AS", "WITH c AS", 1))
def _(spark, sf):
    one = lambda xs: spark.createDataFrame([(x,) for x in xs], "word string")
    return vo.domain_vocabulary(vo.word_counts(documents(spark, sf)), one(_STOPS), one(["loadgrid", "quaternion", "the", "ox"]))


_SETS = """, d AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents), e AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM eval_items)""".replace(", d AS", "WITH d AS", 1)


def _sets(spark, sf):
    return vo.word_counts(documents(spark, sf)).select("word"), vo.word_counts(table(spark, sf, "eval_items")).select("word")


@query("vocab_union", f"{_SETS} SELECT word FROM d UNION SELECT word FROM e")
def _(spark, sf):
    d, e = _sets(spark, sf)
    return d.union(e).distinct()


@query("vocab_difference", f"{_SETS} SELECT word FROM d EXCEPT SELECT word FROM e")
def _(spark, sf):
    d, e = _sets(spark, sf)
    return d.join(e, "word", "left_anti")


@query("vocab_intersection", f"{_SETS} SELECT word FROM d INTERSECT SELECT word FROM e")
def _(spark, sf):
    d, e = _sets(spark, sf)
    return d.join(e, "word", "left_semi")


@query(
    "token_candidates",
    f"{_SETS}, k AS (SELECT lower(t) AS t FROM (SELECT unnest(keywords) AS t FROM topic_rules UNION ALL SELECT n_name FROM nation)) SELECT word FROM d WHERE length(word) >= 5 AND regexp_matches(word, '^[a-z]+$') AND word NOT IN (SELECT word FROM e) AND word NOT IN (SELECT t FROM k)",
)
def _(spark, sf):
    """Tokens so far are the keywords and the nations' names in capitals; the words of the events count as common."""
    d, e = _sets(spark, sf)
    t = table(spark, sf, "topic_rules").select(F.explode("keywords").alias("token")).unionByName(table(spark, sf, "nation").select(F.col("n_name").alias("token")))
    return vo.token_candidates(d, t, e)


@query("ordered_distinct_answers", "SELECT a, min(answer_id) AS first FROM A WHERE a IS NOT NULL GROUP BY a", "A")
def _(spark, sf):
    return vo.ordered_distinct(answers(spark, sf).where("a is not null"), "a", "answer_id")


@query(
    "source_compare",
    """, x AS (SELECT path, count(*) AS n, list_sort(list(DISTINCT prefix) FILTER (prefix IS NOT NULL)) AS kinds FROM P GROUP BY path), y AS (SELECT path, count(*) AS n FROM answers GROUP BY path)
    SELECT coalesce(x.path, y.path) AS path, x.n AS n_pairs, y.n AS n_answers, x.n IS DISTINCT FROM y.n AS differs FROM x FULL JOIN y ON x.path = y.path""",
    "P",
)
def _(spark, sf):
    x = pairs(spark, sf).groupBy("path").agg(F.count("*").alias("n_pairs"))
    y = table(spark, sf, "answers").groupBy("path").agg(F.count("*").alias("n_answers"))
    return x.join(y, "path", "full").withColumn("differs", ~F.col("n_pairs").eqNullSafe(F.col("n_answers")))


@query(
    "source_set_differences",
    f"""WITH x AS (SELECT DISTINCT path, {S('a')} AS a FROM pairs WHERE path IS NOT NULL AND {S('a')} <> ''), y AS (SELECT DISTINCT path, {S('a')} AS a FROM blocks WHERE path IS NOT NULL AND {S('a')} <> ''),
    j AS (SELECT path, a, x.a IS NOT NULL AS l, y.a IS NOT NULL AS r FROM x FULL JOIN y USING (path, a))
    SELECT path, count(*) FILTER (l AND NOT r) AS only_left, count(*) FILTER (r AND NOT l) AS only_right, count(*) FILTER (l AND r) AS both, bool_or(l <> r) AS differs FROM j GROUP BY path""".replace("x.a IS NOT NULL AS l, y.a IS NOT NULL AS r", "x.k IS NOT NULL AS l, y.k IS NOT NULL AS r").replace("AS a FROM", "AS a, 1 AS k FROM"),
)
def _(spark, sf):
    """The sets of answers that pairs and blocks have for each path."""
    said = lambda t: table(spark, sf, t).select("path", strip("a").alias("a"))
    return ru.set_differences(said("pairs").where("a <> ''"), said("blocks").where("a <> ''"), "path", "a")


@query("token_coverage")
def _(spark, sf):
    """Capitalised terms that the public vocabulary cuts into pieces; checked against the tokenizer in the tests."""
    t = documents(spark, sf).select(F.explode(F.regexp_extract_all("text", F.lit("(?:^|[^A-Za-z0-9_])([A-Z][a-z]{2,})"), F.lit(1))).alias("term"))
    n = t.groupBy("term").agg(F.count("*").alias("n")).where("n >= 5")
    return vo.fragmented(n, "/opt/tokenizers/byte_bpe_50k.tiktoken").join(n, "term")



"""Structure, order and quality of lines, blocks and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainmill.functions.text import gate_tokens, n_tokens, rough_tokens, slug, strip, tokens
from grainmill.operators import ordered as od
from grainmill.operators import quality as ql
from grainmill.plans.base import answers, blocks, documents, pairs, query, table
from grainmill.plans.profile import S, W
from grainmill.session import materialize
from grainmill.sources import text as src


@query("short_long_answers", "SELECT block_id, CASE WHEN length(a) < 10 THEN 'short' ELSE 'long' END AS flag, length(a) AS n_chars FROM B WHERE type = 'qa' AND (length(a) < 10 OR length(a) > 300)", "B")
def _(spark, sf):
    b = blocks(spark, sf).where("type = 'qa'").select("block_id", ql.length_flag().alias("flag"), F.length("a").alias("n_chars"))
    return b.where("flag is not null")


@query(
    "token_budget_top",
    """, t AS (SELECT block_id, greatest(1, length(CASE WHEN q IS NOT NULL AND a IS NOT NULL THEN 'Q: ' || q || chr(10) || 'A: ' || a ELSE text END) // 4) AS n FROM B)
    SELECT block_id, n FROM t WHERE n > 110 ORDER BY n DESC, block_id LIMIT 20""",
    "B",
)
def _(spark, sf):
    t = blocks(spark, sf).select("block_id", ql.over_budget("q", "a", "text").alias("n")).where("n is not null")
    return t.orderBy(F.desc("n"), "block_id").limit(20)


@query(
    "command_shape",
    f""", f AS (SELECT block_id, unnest([CASE WHEN len({W('"do"')}) > 3 THEN 'many_words' END, CASE WHEN "do" LIKE 'Type %' OR "do" LIKE 'Use %' THEN 'verb_led' END,
    CASE WHEN contains("do", '.') AND length("do") > 20 THEN 'sentence' END]) AS flag FROM B WHERE type = 'do') SELECT block_id, flag FROM f WHERE flag IS NOT NULL""",
    "B",
)
def _(spark, sf):
    return blocks(spark, sf).where("type = 'do'").select("block_id", F.explode(ql.command_flags()).alias("flag"))


@query("prose_lengths", f"SELECT block_id, len({W('text')}) AS n_words, CASE WHEN len({W('text')}) < 10 THEN 'short' WHEN len({W('text')}) > 55 THEN 'long' END AS flag FROM B WHERE type = 'prose' AND (len({W('text')}) < 10 OR len({W('text')}) > 55)", "B")
def _(spark, sf):
    p = blocks(spark, sf).where("type = 'prose'").select("block_id", n_tokens("text").alias("n_words"))
    return p.withColumn("flag", F.when(F.col("n_words") < 10, "short").when(F.col("n_words") > 55, "long")).where("flag is not null")


@query("prose_without_command", "SELECT block_id FROM B WHERE type = 'prose' AND NOT regexp_matches(lower(text), '(?:type|run|use) [a-z]+') AND len(regexp_extract_all(text, '\"[a-z]+\"')) = 0", "B")
def _(spark, sf):
    p = blocks(spark, sf).where("type = 'prose'")
    return p.where(~F.lower("text").rlike("(?:type|run|use) [a-z]+") & (F.size(F.regexp_extract_all("text", F.lit('("[a-z]+")'), F.lit(1))) == 0)).select("block_id")


@query(
    "broken_lines",
    f"""WITH x AS (SELECT path, line_no, line, lag(line) OVER (PARTITION BY path ORDER BY line_no) AS prev FROM session_log)
    SELECT path, line_no, line FROM x WHERE {S("coalesce(prev, '')")} = '' AND regexp_matches(line, '^[a-z]') AND length(line) < 30 AND NOT regexp_matches(line, '[.!?]')""",
)
def _(spark, sf):
    x = od.neighbours(table(spark, sf, "session_log").select("path", "line_no", "line"), "path", "line_no", ["line"])
    return x.where(ql.broken_line("line", "prev_line")).select("path", "line_no", "line")


_AS_TEXT = """concat_ws(chr(10), 'Q: ' || q, 'A: ' || a, 'Do: ' || "do", text, next_line)"""


@query(
    "double_questions",
    f""", t AS (SELECT block_id, {_AS_TEXT} AS text FROM B),
    l AS (SELECT block_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM (SELECT block_id, CASE WHEN t = '' THEN [] ELSE string_split(t, chr(10)) END AS ls FROM (
      SELECT block_id, regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '\\n\\z', '') AS t FROM t))),
    x AS (SELECT block_id, line_no, line, lead(line) OVER (PARTITION BY block_id ORDER BY line_no) AS nxt FROM l)
    SELECT block_id, line_no, CASE WHEN line LIKE 'Q: %' THEN 'two questions' ELSE 'two answers' END AS issue FROM x WHERE (line LIKE 'Q: %' AND nxt LIKE 'Q: %') OR (line LIKE 'A: %' AND nxt LIKE 'A: %')""",
    "B",
)
def _(spark, sf):
    """Blocks as text again, with the line that came next."""
    b = blocks(spark, sf).select("block_id", F.concat_ws("\n", F.concat(F.lit("Q: "), "q"), F.concat(F.lit("A: "), "a"), F.concat(F.lit("Do: "), "do"), "text", "next_line").alias("body"))
    x = od.line_neighbours(b, "block_id", src.line_array("body"))
    two = lambda p: F.col("line").startswith(p) & F.col("next").startswith(p)
    return x.where(two("Q: ") | two("A: ")).select("block_id", "line_no", F.when(F.col("line").startswith("Q: "), "two questions").otherwise("two answers").alias("issue"))


@query("document_lines", "SELECT doc_id, line_no, line FROM L", "L")
def _(spark, sf):
    return src.lines(documents(spark, sf), "doc_id").where("line is not null")


@query("document_answers", f"SELECT doc_id, line_no, {S('substr(' + S('line') + ', 4)')} AS a FROM L WHERE {S('line')} LIKE 'A: %'", "L")
def _(spark, sf):
    return src.answer_lines(documents(spark, sf), "doc_id")


@query("document_prose_lines", f"SELECT doc_id, line_no, {S('line')} AS line FROM L WHERE {S('line')} <> '' AND NOT {S('line')} LIKE 'Q: %' AND NOT {S('line')} LIKE 'A: %'", "L")
def _(spark, sf):
    return src.prose_lines(documents(spark, sf), "doc_id")


@query(
    "document_paragraphs",
    f""", p AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10) || chr(10)), lambda x: {S('x')}), lambda x: x <> '') AS ps FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, unnest(ps) AS text, generate_subscripts(ps, 1) AS par_no FROM p""".replace(", p AS", "WITH p AS", 1),
)
def _(spark, sf):
    return src.paragraphs(documents(spark, sf), "doc_id")


_PAIRS = f""", m AS (SELECT doc_id, line_no, CASE WHEN line LIKE 'Q: %' THEN 'Q' WHEN line LIKE 'A: %' THEN 'A' ELSE 'Do' END AS mark, {S("regexp_replace(line, '^(?:Q|A|Do): ', '')")} AS body
      FROM L WHERE line LIKE 'Q: %' OR line LIKE 'A: %' OR line LIKE 'Do: %'),
    n AS (SELECT *, lead(mark) OVER w AS nm, lead(body) OVER w AS nb, lag(mark) OVER w AS pm FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
    lp AS (SELECT doc_id, line_no, CASE WHEN mark = 'Q' THEN body ELSE '' END AS q, CASE WHEN mark <> 'Q' THEN body WHEN nm IS NOT NULL AND nm <> 'Q' THEN nb ELSE '' END AS a,
      CASE WHEN mark <> 'Q' THEN mark WHEN nm <> 'Q' THEN nm END AS prefix FROM n WHERE mark = 'Q' OR pm IS NULL OR pm <> 'Q')"""


@query("qa_pairs", f"{_PAIRS} SELECT * FROM lp", "L")
def _(spark, sf):
    return src.line_pairs(documents(spark, sf), "doc_id")


@query("orphans", f"{_PAIRS} SELECT doc_id, line_no, CASE WHEN q = '' THEN 'response' ELSE 'question' END AS orphan FROM lp WHERE q = '' OR prefix IS NULL", "L")
def _(spark, sf):
    p = src.line_pairs(documents(spark, sf), "doc_id").where("q = '' or prefix is null")
    return p.select("doc_id", "line_no", F.when(F.col("q") == "", "response").otherwise("question").alias("orphan"))


@query(
    "adjacent_pairs",
    f""", s AS (SELECT doc_id, line_no, {S('line')} AS x FROM L), n AS (SELECT *, lead(x) OVER (PARTITION BY doc_id ORDER BY line_no) AS y FROM s)
    SELECT doc_id, line_no, {S('substr(x, 4)')} AS q, {S('substr(y, 4)')} AS a FROM n WHERE x LIKE 'Q: %' AND y LIKE 'A: %'""",
    "L",
)
def _(spark, sf):
    return src.adjacent_pairs(documents(spark, sf), "doc_id")


@query("document_blocks")
def _(spark, sf):
    """Tested against a plain reading on fixtures; SQL has no loop for it."""
    return src.blocks(documents(spark, sf), "doc_id")


@query(
    "two_line_blocks",
    f"""WITH p AS (SELECT doc_id, list_filter(list_transform(string_split_regex(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '\\n\\n+'), lambda x: {S('x')}), lambda x: x <> '') AS ps FROM documents WHERE text IS NOT NULL)
    , u AS (SELECT doc_id, unnest(ps) AS x, generate_subscripts(ps, 1) AS par_no FROM p), l AS (SELECT *, string_split(x, chr(10))[1] AS l1, coalesce(string_split(x, chr(10))[2], '') AS l2 FROM u),
    k AS (SELECT *, CASE WHEN l1 LIKE 'Q: %' AND l2 LIKE 'A: %' THEN 'A' WHEN l1 LIKE 'Q: %' AND l2 LIKE 'Do: %' THEN 'Do' END AS prefix FROM l)
    SELECT doc_id, par_no::INT AS par_no, CASE WHEN prefix IS NULL THEN 'prose' ELSE 'qa' END AS type, CASE WHEN prefix IS NOT NULL THEN {S('substr(l1, 4)')} END AS q,
      CASE prefix WHEN 'A' THEN {S('substr(l2, 4)')} WHEN 'Do' THEN {S('substr(l2, 5)')} END AS a, prefix, CASE WHEN prefix IS NULL THEN x END AS text FROM k""",
)
def _(spark, sf):
    return src.two_line_blocks(documents(spark, sf), "doc_id")


@query("test_prompts", f"SELECT doc_id, line_no, {S('line')} || chr(10) || 'A:' AS prompt FROM L WHERE {S('line')} LIKE 'Q:%'", "L")
def _(spark, sf):
    return src.test_prompts(documents(spark, sf), "doc_id")


_SESSIONS = """WITH s AS (SELECT path, line_no, line, sum(CASE WHEN regexp_matches(line, 'llm (?:ask|generate) ".*"') THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY line_no) AS session FROM session_log)"""


@query("session_lines", f"{_SESSIONS} SELECT path, line_no, line, session::BIGINT AS session FROM s WHERE session > 0")
def _(spark, sf):
    return od.sessions(table(spark, sf, "session_log").select("path", "line_no", "line"))


@query(
    "session_summary",
    f"""{_SESSIONS} SELECT path, session::BIGINT AS session, count(*) AS n_lines, count(*) FILTER (line LIKE '[LLM]%') AS n_debug, trim(left(regexp_replace(regexp_replace(lower(arg_min(line, line_no)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 50), '-') AS slug
    FROM s WHERE session > 0 GROUP BY path, session""",
)
def _(spark, sf):
    s = od.sessions(table(spark, sf, "session_log").select("path", "line_no", "line"))
    g = s.groupBy("path", "session").agg(F.count("*").alias("n_lines"), F.count_if(F.col("line").startswith("[LLM]")).alias("n_debug"), F.min_by("line", "line_no").alias("head"))
    return g.select("path", "session", "n_lines", "n_debug", slug("head").alias("slug"))


@query(
    "neighbouring_answers",
    "SELECT answer_id, lag(answer_id) OVER w AS prev_answer_id, lead(answer_id) OVER w AS next_answer_id FROM A WINDOW w AS (PARTITION BY path ORDER BY line_no)",
    "A",
)
def _(spark, sf):
    n = od.neighbours(answers(spark, sf).select("answer_id", "path", "line_no"), "path", "line_no", ["answer_id"])
    return n.select("answer_id", "prev_answer_id", "next_answer_id")


@query(
    "topic_transitions",
    f""", w AS (SELECT path, line_no, list_distinct(list_slice({W('lower(a)')}, 1, 20)) AS w FROM A WHERE {S('a')} <> ''),
    n AS (SELECT path, w, lag(w) OVER (PARTITION BY path ORDER BY line_no) AS p FROM w)
    SELECT path, count(*) AS n, count(*) FILTER (len(p) > 0 AND len(list_intersect(w, p)) < 3) AS changes FROM n GROUP BY path""",
    "A",
)
def _(spark, sf):
    a = answers(spark, sf).where(strip("a") != "")
    return od.transitions(a, "path", "line_no", F.array_distinct(F.slice(tokens(F.lower(F.col("a"))), 1, 20)))


@query(
    "question_quality",
    f""", s AS (SELECT pair_id, {S("regexp_replace(lower(q), '[?]+$', '')")} AS s FROM P WHERE q IS NOT NULL), w AS (SELECT pair_id, s, {W('s')} AS w FROM s),
    r AS (SELECT pair_id, CASE WHEN len(w) < 2 THEN 'too_short' WHEN w[len(w)] IN ({", ".join(f"'{x}'" for x in ql.WEAK_ENDINGS)}) THEN 'weak_ending' WHEN len(w) < 5 AND len(list_distinct(w)) < len(w) THEN 'repeated_words'
      WHEN regexp_matches(s, '^(?:explain|describe|can you describe|tell me about) (?:many|only|there|here|where|much|very|just|also|even)(?:$|[^a-z0-9_])') THEN 'vague_subject'
      WHEN regexp_matches(s, '^can i (?:there|this|that|here|only|many)$') THEN 'bare_can_i' END AS reason FROM w)
    SELECT pair_id, reason FROM r WHERE reason IS NOT NULL""",
    "P",
)
def _(spark, sf):
    return pairs(spark, sf).where("q is not null").select("pair_id", ql.question_quality().alias("reason")).where("reason is not null")


@query("off_topic_answers", "SELECT block_id FROM B WHERE contains(a, 'I can only answer') OR contains(a, 'I can only help') OR contains(a, 'I have no internet') OR contains(a, 'I cannot') OR contains(a, 'I run entirely')", "B")
def _(spark, sf):
    return blocks(spark, sf).where(ql.off_topic()).select("block_id")


_PART = "regexp_extract_all(upper(text), '(?:^|[^A-Z0-9_])([A-Z]{2,5}[0-9]{3,5}[A-Z]?)(?:$|[^A-Z0-9_])', 1)"


@query(
    "part_numbers",
    f"""WITH f AS (SELECT DISTINCT doc_id, part FROM (SELECT doc_id, unnest({_PART}) AS part FROM (SELECT doc_id, regexp_replace(text, '[^A-Za-z0-9_]', '  ', 'g') AS text FROM documents))),
    k AS (SELECT part FROM f GROUP BY part HAVING count(*) > 2) SELECT doc_id, part FROM f WHERE part NOT IN (SELECT part FROM k) AND NOT starts_with(part, 'MR')""",
)
def _(spark, sf):
    """Numbers that many documents name are taken for known, those that begin with MR are excluded."""
    d = documents(spark, sf).select("doc_id", F.upper("text").alias("text"))
    none = spark.createDataFrame([], "part string")
    every = materialize(ql.part_numbers(d, ["doc_id"], "text", none, none), "parts")
    known = every.groupBy("part").agg(F.count("*").alias("n")).where("n > 2").select("part")
    return ql.part_numbers(d, ["doc_id"], "text", known, every.where("startswith(part, 'MR')").select("part").distinct())


_Q = S("regexp_replace(lower(q), '[?]+$', '')")
_REASON = f"""CASE WHEN len({W(_Q)}) < 2 THEN 'too_short' WHEN list_last({W(_Q)}) IN ({", ".join(f"'{x}'" for x in ql.WEAK_ENDINGS)}) THEN 'weak_ending' WHEN len({W(_Q)}) < 5 AND len(list_distinct({W(_Q)})) < len({W(_Q)}) THEN 'repeated_words'
      WHEN regexp_matches({_Q}, '^(?:explain|describe|can you describe|tell me about) (?:many|only|there|here|where|much|very|just|also|even)(?:$|[^a-z0-9_])') THEN 'vague_subject'
      WHEN regexp_matches({_Q}, '^can i (?:there|this|that|here|only|many)$') THEN 'bare_can_i' END"""
_ISSUES = f""", i AS (SELECT block_id, unnest([
      CASE WHEN type = 'qa' AND length(a) < 10 THEN 'short_answer' WHEN type = 'qa' AND length(a) > 300 THEN 'long_answer' END,
      CASE WHEN length(CASE WHEN q IS NOT NULL AND a IS NOT NULL THEN 'Q: ' || q || chr(10) || 'A: ' || a ELSE text END) // 4 > 110 THEN 'over_budget' END,
      CASE WHEN type = 'do' AND (len({W('"do"')}) > 3 OR "do" LIKE 'Type %' OR "do" LIKE 'Use %' OR (contains("do", '.') AND length("do") > 20)) THEN 'odd_command' END,
      CASE WHEN type = 'prose' AND len({W('text')}) < 10 THEN 'short_prose' END, CASE WHEN type = 'prose' AND len({W('text')}) > 55 THEN 'long_prose' END,
      CASE WHEN type LIKE 'orphan%' THEN type END,
      CASE WHEN type IN ('qa', 'do') AND coalesce({S('coalesce(a, "do")')}, '') = '' THEN 'blank_response' END,
      'question_' || {_REASON}]) AS issue FROM B), n AS (SELECT issue, count(*) AS n FROM i WHERE issue IS NOT NULL GROUP BY issue)"""
_GATES = ("orphan_q", "orphan_a", "orphan_do", "blank_response", "over_budget", "short_prose", "odd_command")


@query("issue_rollup", f"{_ISSUES} SELECT issue, n FROM n", "B")
def _(spark, sf):
    return ql.issues(blocks(spark, sf)).groupBy("issue").agg(F.count("*").alias("n"))


@query("issue_gates", f'{_ISSUES} SELECT g."check", coalesce(n, 0) AS n_issues, n IS NULL AS passed FROM (VALUES {", ".join(f"({chr(39)}{x}{chr(39)})" for x in _GATES)}) g("check") LEFT JOIN n ON n.issue = g."check"', "B")
def _(spark, sf):
    n = ql.issues(blocks(spark, sf)).groupBy("issue").agg(F.count("*").alias("n"))
    return ql.gates(n, list(_GATES))


@query("adjectival_regions", "SELECT n_name, CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN 'old world' WHEN r_name = 'AMERICA' THEN 'new world' ELSE 'other' END AS kind FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select("n_name", F.when(F.col("r_name").isin("ASIA", "EUROPE"), "old world").when(F.col("r_name") == "AMERICA", "new world").otherwise("other").alias("kind"))


@query("rough_token_sizes", "SELECT doc_id, greatest(1, length(text) // 4) AS n FROM documents WHERE text IS NOT NULL")
def _(spark, sf):
    return documents(spark, sf).where("text is not null").select("doc_id", rough_tokens("text").alias("n"))


@query("gate_token_counts", "SELECT doc_id, len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS n FROM documents WHERE text IS NOT NULL")
def _(spark, sf):
    return documents(spark, sf).where("text is not null").select("doc_id", F.size(gate_tokens("text")).cast("long").alias("n"))


@query(
    "interleaved_prose",
    """, q AS (SELECT block_id, row_number() OVER (ORDER BY block_id) - 1 AS k FROM B WHERE type IN ('qa', 'do')), p AS (SELECT block_id, row_number() OVER (ORDER BY block_id) - 1 AS k FROM B WHERE type = 'prose'),
    c AS (SELECT (SELECT count(*) FROM q) AS nq, (SELECT count(*) FROM p) AS np)
    SELECT block_id, k::DOUBLE AS pos FROM q UNION ALL SELECT block_id, floor((k + 1) * nq / (np + 1)) - 0.5 + k / (2.0 * greatest(np, 1)) AS pos FROM p, c""",
    "B",
)
def _(spark, sf):
    """Row numbers over the whole table come from counts of chunks, not from a window over all rows."""
    b = blocks(spark, sf).select("block_id", "type").withColumn("all", F.lit(0))
    numbered = lambda cond: od.running_sum(b.where(cond), "all", "block_id", F.lit(1), "n", 2_000).select("block_id", (F.col("n") - 1).alias("k"))
    q, p = numbered("type in ('qa', 'do')"), numbered("type = 'prose'")
    n_q, n_p = b.agg(F.count_if(F.col("type").isin("qa", "do")), F.count_if(F.col("type") == "prose")).first()
    return od.interleave(q, p, "k", n_q, n_p).select("block_id", "pos")



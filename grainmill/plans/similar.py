"""Near repeats, merges, trims, graphs and generated questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainmill.functions.text import rough_tokens, strip
from grainmill.operators import generate as ge
from grainmill.operators import graph as gr
from grainmill.operators import packing as pk
from grainmill.operators import profile as op
from grainmill.operators import ranked as rk
from grainmill.operators import similarity as si
from grainmill.operators import tokenize as tk
from grainmill.plans.base import answers, blocks, documents, pairs, query, table
from grainmill.plans.profile import S, W

#: The vocabulary that the queries on tokens use.
VOCABULARY_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"

_NEAR = f""", t AS (SELECT DISTINCT a FROM A WHERE {S('a')} <> ''), s AS (SELECT a, list_distinct({W('lower(trim(a, chr(32)))')}) AS w FROM t),
 near AS (SELECT x.a AS a, y.a AS b, len(list_intersect(x.w, y.w)) AS shared, least(len(x.w), len(y.w)) AS smaller FROM s x JOIN s y ON x.a < y.a)"""


def _said(spark, sf):
    return answers(spark, sf).where(strip("a") != "").select("a")


@query("near_duplicate_pairs", f"{_NEAR} SELECT a, b, shared, smaller FROM near WHERE shared * 4 >= smaller * 3", "A")
def _(spark, sf):
    return si.near_pairs(_said(spark, sf))


@query(
    "near_duplicates_ranked",
    f"{_NEAR} SELECT row_number() OVER (ORDER BY shared / smaller DESC, a DESC, b DESC) AS place, a, b, shared / smaller AS similarity FROM near WHERE shared * 4 >= smaller * 3",
    "A",
)
def _(spark, sf):
    # every row counts by its text alone, so second deliveries needn't be told apart
    return rk.ranked_near_pairs(table(spark, sf, "answers").where(strip("a") != "").select("a"))


_GROUPS = (
    _NEAR.replace(", t AS", "WITH RECURSIVE A AS (SELECT DISTINCT answer_id, path, line_no, a FROM answers), t AS", 1)
    + """, e AS (SELECT a, b FROM near WHERE shared * 20 >= smaller * 17 AND NOT starts_with(a, b) AND NOT starts_with(b, a)), sym AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    walk AS (SELECT a, a AS g FROM sym UNION SELECT sym.b, walk.g FROM walk JOIN sym ON sym.a = walk.a), grp AS (SELECT a, min(g) AS "group" FROM walk GROUP BY a),
    n AS (SELECT a, count(*) AS n FROM A WHERE a IS NOT NULL GROUP BY a),
    c AS (SELECT row_number() OVER (ORDER BY sum(n) DESC, "group") AS place, sum(n)::BIGINT AS weight, list(a ORDER BY n DESC, length(a), a) AS members FROM grp JOIN n USING (a) GROUP BY "group")"""
)


@query("near_duplicate_groups", f'{_GROUPS} SELECT a, "group" FROM grp')
def _(spark, sf):
    return si.divergent_groups(_said(spark, sf))


@query("cluster_weights", f"{_GROUPS} SELECT place, weight, members FROM c")
def _(spark, sf):
    a = answers(spark, sf)
    return si.clusters(si.divergent_groups(_said(spark, sf)), op.frequency(a, "a"))


_RATED = "SELECT 'Orders of customer ' || o_custkey || ' are filled.' AS body, count(*) FILTER (o_orderstatus = 'F') AS yes, count(*) FILTER (o_orderstatus <> 'F') AS no FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'F') > 0 AND count(*) FILTER (o_orderstatus <> 'F') > 0"


def _rated(spark, sf):
    """What each order says of its customer's orders, as an answer with Yes or No."""
    lead = F.when(F.col("o_orderstatus") == "F", "Yes. ").otherwise("No. ")
    return table(spark, sf, "orders").select(F.concat(lead, F.lit("Orders of customer "), F.col("o_custkey").cast("string"), F.lit(" are filled.")).alias("a"))


@query(
    "review_list",
    f"{_GROUPS}, p AS ({_RATED}) SELECT 'cluster' AS section, place, array_to_string(members, chr(10)) AS line FROM c UNION ALL SELECT 'yes/no', row_number() OVER (ORDER BY body), body FROM p",
)
def _(spark, sf):
    found = si.clusters(si.divergent_groups(_said(spark, sf)), op.frequency(answers(spark, sf), "a"))
    return si.review(found, si.polarity_conflicts(_rated(spark, sf)))


_SQ = r"trim(regexp_replace({0}, '[ \t\n\f\r]+', ' ', 'g'), ' ')"


@query(
    "canonical_merge",
    f""", r AS (SELECT block_id, coalesce(a, "do") AS response FROM B UNION ALL SELECT doc_id, unnest(regexp_extract_all(text, '(?:Type|Run|Use) [a-z]+(?: [a-z0-9]+)?')) FROM documents),
    c AS (SELECT response AS a, count(*) AS n, min(block_id) AS first FROM r WHERE {S('response')} <> '' GROUP BY response),
    t AS (SELECT a, n, first, {_SQ.format('a')} AS s FROM c),
    k AS (SELECT *, regexp_matches(s, '^(?:Type|Run|Use) .') AS led, regexp_replace(s, '^(?:Type|Run|Use) (.)', '\\1') AS key FROM t),
    g AS (SELECT led, key, count(*) AS m, arg_max(s, (starts_with(s, 'Type '), n, -length(a), -first)) AS w FROM k GROUP BY led, key HAVING count(*) > 1),
    o AS (SELECT led, key, CASE WHEN led THEN 'Type ' || key ELSE w END AS canonical FROM g)
    SELECT a, canonical FROM k JOIN o USING (led, key) WHERE a <> canonical""",
    "B",
)
def _(spark, sf):
    """The responses, and the commands that documents name."""
    said = F.regexp_extract_all("text", F.lit("((?:Type|Run|Use) [a-z]+(?: [a-z0-9]+)?)"), F.lit(1))
    named = documents(spark, sf).select(F.col("doc_id").alias("block_id"), F.explode(said).alias("a"))
    b = blocks(spark, sf).select("block_id", F.coalesce("a", "do").alias("a")).unionByName(named)
    return si.canonical_merge(op.frequency(b, "a", "block_id"))


@query("merged_answers", r""", m AS (SELECT a, min(trim(regexp_replace(a, '[ \t\n\f\r]+', ' ', 'g'), ' ')) AS c FROM A WHERE a IS NOT NULL GROUP BY a)
 SELECT answer_id, coalesce(CASE WHEN m.c <> A.a THEN m.c END, A.a) AS a, coalesce(m.c <> A.a, false) AS changed FROM A LEFT JOIN m ON A.a = m.a""", "A")
def _(spark, sf):
    a = answers(spark, sf).select("answer_id", "a")
    from grainmill.functions.text import squeeze

    m = a.where("a is not null").select("a").distinct().withColumn("to", squeeze("a")).where("a <> to")
    return si.apply_map(a, m, "a", "to")


_BODIES = r"A AS (SELECT DISTINCT answer_id, path, line_no, a FROM answers), said AS (SELECT a FROM A WHERE a IS NOT NULL UNION SELECT regexp_extract(a, '^[^.]*[.]') FROM A WHERE a IS NOT NULL)"


def _bodies(spark, sf):
    """The answers, and the first sentence of each as an answer of its own: bodies that others go on from."""
    a = answers(spark, sf).where("a is not null").select("a")
    return a.unionByName(a.select(F.regexp_extract("a", "^[^.]*[.]", 0).alias("a"))).distinct()


@query(
    "prefix_trim",
    rf"""WITH RECURSIVE {_BODIES}, x AS (SELECT DISTINCT regexp_replace(a, '^(?:Yes|No)\.[ \t\n\f\r]+(.)', '\1') AS x FROM said), b AS (SELECT x FROM x WHERE x <> ''),
    p AS (SELECT l.x AS x, s.x AS core FROM b l JOIN b s ON starts_with(l.x, s.x || ' ') WHERE s.x LIKE '%.' AND len(list_filter(string_split_regex(s.x, '[ \t\n\f\r]+'), lambda w: w <> '')) >= 3),
    f AS (SELECT x, arg_min(core, length(core)) AS core FROM p GROUP BY x),
    w AS (SELECT x, core FROM f UNION SELECT w.x, f.core FROM w JOIN f ON w.core = f.x)
    SELECT x AS a, core FROM w WHERE core NOT IN (SELECT x FROM f)""",
)
def _(spark, sf):
    return si.core_of(_bodies(spark, sf))


@query("polarity_conflicts", _RATED)
def _(spark, sf):
    return si.polarity_conflicts(_rated(spark, sf))


# ---- graphs ----

# The parts make a forest: part k comes from part k div 3, by way of its size and brand; every seventh size stands alone.
_EVO_SQL = """g AS (SELECT p_partkey::VARCHAR AS name, (p_partkey // 3)::VARCHAR AS parent, CASE p_size % 3 WHEN 0 THEN 'level' WHEN 1 THEN 'stone' ELSE 'trade' END AS method,
    CASE p_size % 3 WHEN 0 THEN p_size::VARCHAR WHEN 1 THEN p_brand END AS detail, p_partkey // 3 >= 1 AND p_size % 7 <> 0 AS linked FROM part),
    e AS (SELECT parent AS src, name AS dst, method, detail FROM g WHERE linked), n AS (SELECT name FROM g)"""


def _evo(spark, sf):
    kind = F.expr("CASE p_size % 3 WHEN 0 THEN 'level' WHEN 1 THEN 'stone' ELSE 'trade' END")
    detail = F.expr("CASE p_size % 3 WHEN 0 THEN string(p_size) WHEN 1 THEN p_brand END")
    p = table(spark, sf, "part").where("p_partkey div 3 >= 1 and p_size % 7 <> 0")
    return p.select(F.expr("string(p_partkey div 3)").alias("src"), F.col("p_partkey").cast("string").alias("dst"), kind.alias("method"), detail.alias("detail"))


def _names(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("name"))


_WALK = f"WITH RECURSIVE {_EVO_SQL}, w AS (SELECT name AS base, name AS here, name AS path FROM n WHERE name NOT IN (SELECT dst FROM e) UNION ALL SELECT base, dst, path || ' > ' || dst FROM w JOIN e ON w.here = e.src)"


@query("evolution_chains", f"{_WALK} SELECT base, here AS final, path FROM w WHERE here NOT IN (SELECT src FROM e)")
def _(spark, sf):
    return gr.chains(_names(spark, sf), _evo(spark, sf))


@query("base_forms", f"{_WALK} SELECT here AS name, base FROM w")
def _(spark, sf):
    return gr.walks(_names(spark, sf), _evo(spark, sf)).select(F.col("at").alias("name"), "base")


@query("never_evolves", f"WITH {_EVO_SQL} SELECT name FROM n WHERE name NOT IN (SELECT src FROM e) AND name NOT IN (SELECT dst FROM e)")
def _(spark, sf):
    e = _evo(spark, sf)
    return _names(spark, sf).join(e.select(F.col("src").alias("name")), "name", "left_anti").join(e.select(F.col("dst").alias("name")), "name", "left_anti")


@query("evolves_from", f"WITH {_EVO_SQL} SELECT dst AS name, max(src) AS parent FROM e GROUP BY dst")
def _(spark, sf):
    return _evo(spark, sf).groupBy(F.col("dst").alias("name")).agg(F.max("src").alias("parent"))


@query("method_lists", f"WITH {_EVO_SQL} SELECT method, coalesce(detail, '') AS detail, count(*) AS n, array_to_string(list_sort(list(src)), ', ') AS names FROM e GROUP BY 1, 2")
def _(spark, sf):
    return _evo(spark, sf).groupBy("method", F.coalesce("detail", F.lit("")).alias("detail")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("src")), ", ").alias("names"))


_BY_METHOD = "CASE method WHEN 'level' THEN dst || ' at level ' || detail WHEN 'stone' THEN dst || ' with a ' || detail ELSE dst || ' when traded' END"


@query(
    "evolution_sentences",
    f"""WITH {_EVO_SQL}, o AS (SELECT src, count(*) AS k, string_agg({_BY_METHOD}, ', ' ORDER BY dst) AS parts FROM e GROUP BY src)
    SELECT n.name, CASE WHEN k IS NULL THEN n.name || ' does not evolve.' ELSE n.name || ' evolves into ' || parts || '.' END AS answer FROM n LEFT JOIN o ON o.src = n.name""",
)
def _(spark, sf):
    return ge.chain_sentences(_names(spark, sf), _evo(spark, sf))


@query(
    "relationship_questions",
    f"""WITH {_EVO_SQL} SELECT 'What does ' || src || ' evolve into?' AS q, dst AS a FROM e UNION ALL SELECT 'What does ' || dst || ' evolve from?', src FROM e
    UNION ALL SELECT 'How does ' || src || ' become ' || dst || '?', CASE method WHEN 'level' THEN 'Level ' || src || ' up to level ' || detail || '.' WHEN 'stone' THEN 'Use a ' || detail || ' on ' || src || '.' ELSE 'Trade ' || src || '.' END FROM e""",
)
def _(spark, sf):
    return ge.relationship_questions(_evo(spark, sf))


@query("tree_edges", "SELECT r_name AS src, n_name AS dst FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def _(spark, sf):
    """One JSON tree for each region: its nations, and the suppliers of these."""
    leaf = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.collect_list(F.struct(F.col("s_name").alias("name"))).alias("into"))
    n = table(spark, sf, "nation").join(leaf, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    mid = n.groupBy("n_regionkey").agg(F.collect_list(F.struct(F.col("n_name").alias("name"), "into")).alias("into"))
    r = table(spark, sf, "region").join(mid, F.col("n_regionkey") == F.col("r_regionkey"))
    return gr.tree_edges(r.select(F.to_json(F.struct(F.col("r_name").alias("name"), "into")).alias("tree")), "tree", "name", "into", depth=4)


@query("supply_components")
def _(spark, sf):
    """Parts and suppliers linked by an order line; checked against union-find in the tests."""
    l = table(spark, sf, "lineitem")
    return gr.connected_components(l.select((F.col("l_partkey") * 2).alias("src"), (F.col("l_suppkey") * 2 + 1).alias("dst")))


@query(
    "part_components",
    f"""WITH RECURSIVE {_EVO_SQL}, y AS (SELECT src::BIGINT AS a, dst::BIGINT AS b FROM e UNION SELECT dst::BIGINT, src::BIGINT FROM e), w AS (SELECT a, a AS g FROM y UNION SELECT y.b, w.g FROM w JOIN y ON y.a = w.a)
    SELECT a AS node, min(g) AS component FROM w GROUP BY a""",
)
def _(spark, sf):
    return gr.connected_components(_evo(spark, sf))


# ---- generated questions ----

_TEMPLATES = [("region", 1, "Which region is {name} in?", "{name} is in {value}."), ("region", 2, "Where is {name}?", "In {value}."), ("key", 3, "What number has {name}?", "{name} has number {value}.")]


def _templates(spark):
    return spark.createDataFrame(_TEMPLATES, "kind string, ord int, ask string, say string")


_GEN = """t AS (SELECT * FROM (VALUES ('region', 1, 'Which region is {name} in?', '{name} is in {value}.'), ('region', 2, 'Where is {name}?', 'In {value}.'), ('key', 3, 'What number has {name}?', '{name} has number {value}.')) t(kind, ord, ask, say)),
 g AS (SELECT ord, replace(ask, '{name}', n_name) AS q, replace(replace(say, '{name}', n_name), '{value}', CASE WHEN kind = 'region' THEN r_name ELSE n_nationkey::VARCHAR END) AS a FROM nation JOIN region ON n_regionkey = r_regionkey, t)"""


def _facts(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return ge.entity_questions(n, _templates(spark), "n_name", {"region": "r_name", "key": "n_nationkey"})


@query("entity_questions", f"WITH {_GEN} SELECT ord, q, a FROM g")
def _(spark, sf):
    return _facts(spark, sf)


@query("question_variants", f"WITH {_GEN} SELECT DISTINCT q, a FROM (SELECT q, a FROM g UNION ALL SELECT regexp_replace(lower(q), '[ ?.]+$', ''), a FROM g)")
def _(spark, sf):
    return ge.variants(_facts(spark, sf))


# Kinds are nations; what one does to another follows from their numbers; suppliers are of two kinds, or of one.
_MULT = "CASE ({a} * 7 + {d} * 3) % 8 WHEN 0 THEN 2.0 WHEN 1 THEN 0.5 WHEN 2 THEN 0.0 WHEN 3 THEN 2.0 END"
_CHART_SQL = f"""c AS (SELECT x.n_name AS atk, y.n_name AS def, {_MULT.format(a='x.n_nationkey', d='y.n_nationkey')}::DOUBLE AS mult FROM nation x, nation y),
    f AS (SELECT atk, def, coalesce(mult, 1.0)::DOUBLE AS mult FROM c),
    b AS (SELECT s_name AS name, list_distinct([x.n_name, y.n_name]) AS kinds FROM supplier JOIN nation x ON x.n_nationkey = s_nationkey JOIN nation y ON y.n_nationkey = s_suppkey % 25)"""


def _full(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    x, y = n.toDF("ka", "atk"), n.toDF("kd", "def")
    chart = x.join(F.broadcast(y), F.lit(True)).select("atk", "def", F.expr(_MULT.format(a="ka", d="kd")).cast("double").alias("mult")).where("mult is not null")
    return ge.matchups(chart, n.select(F.col("n_name").alias("kind")))


def _beasts(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), "s_nationkey", (F.col("s_suppkey") % 25).alias("k2"))
    j = s.join(F.broadcast(n.toDF("s_nationkey", "one")), "s_nationkey").join(F.broadcast(n.toDF("k2", "two")), "k2")
    return j.select("name", F.array_distinct(F.array("one", "two")).alias("kinds"))


@query("matchup_table", f"WITH {_CHART_SQL} SELECT * FROM f")
def _(spark, sf):
    return _full(spark, sf)


@query(
    "kind_multipliers",
    f"WITH {_CHART_SQL}, l AS (SELECT def, list(atk) FILTER (mult = 0) AS immune, list(atk) FILTER (mult = 2) AS weak, list(atk) FILTER (mult = 0.5) AS resist FROM f GROUP BY def) SELECT def, atk, mult FROM f JOIN l USING (def)",
)
def _(spark, sf):
    """The chart read from three lists of each defender, immune before weak before resist."""
    m = _full(spark, sf)
    some = lambda x: F.collect_list(F.when(F.col("mult") == x, F.col("atk")))
    lists = m.groupBy("def").agg(some(0.0).alias("immune"), some(2.0).alias("weak"), some(0.5).alias("resist"))
    return m.select("def", "atk").join(lists, "def").select("def", "atk", ge.multiplier(F.col("atk"), F.col("immune"), F.col("weak"), F.col("resist")).alias("mult"))


@query(
    "matchup_products",
    f"""WITH {_CHART_SQL}, e AS (SELECT name, unnest(kinds) AS def FROM b), m AS (SELECT name, atk, product(mult) AS mult FROM e JOIN f USING (def) GROUP BY name, atk)
    SELECT name, atk, mult, CASE WHEN mult = 0 THEN 'immune' WHEN mult >= 4 THEN 'quadruple' WHEN mult > 1 THEN 'double' WHEN mult < 1 THEN 'resist' END AS bucket FROM m""",
)
def _(spark, sf):
    return ge.defence(_beasts(spark, sf), _full(spark, sf))


@query("offence_coverage", f"WITH {_CHART_SQL}, e AS (SELECT name, unnest(kinds) AS atk FROM b) SELECT name, list_sort(list(DISTINCT def)) AS covered FROM e JOIN f USING (atk) WHERE mult > 1 GROUP BY name")
def _(spark, sf):
    return ge.offence(_beasts(spark, sf), _full(spark, sf))


@query("kind_combinations", f"WITH {_CHART_SQL} SELECT list_sort(kinds) AS kinds, count(*) AS n FROM b GROUP BY 1")
def _(spark, sf):
    return _beasts(spark, sf).groupBy(F.array_sort("kinds").alias("kinds")).agg(F.count("*").alias("n"))


@query("immunities", f"WITH {_CHART_SQL} SELECT def, array_to_string(list_sort(list(atk)), ', ') AS immune_to FROM f WHERE mult = 0 GROUP BY def")
def _(spark, sf):
    return _full(spark, sf).where("mult = 0").groupBy("def").agg(F.array_join(F.array_sort(F.collect_list("atk")), ", ").alias("immune_to"))


@query("larger_pairs", """SELECT a.p_name AS a, b.p_name AS b, CASE WHEN a.p_size > b.p_size THEN a.p_name WHEN b.p_size > a.p_size THEN b.p_name END AS larger FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1""")
def _(spark, sf):
    """Every part against the next one."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    j = part.toDF("x", "a", "sa").join(part.select((F.col("p_partkey") - 1).alias("x"), F.col("p_name").alias("b"), F.col("p_size").alias("sb")), "x")
    return j.select("a", "b", F.when(F.col("sa") > F.col("sb"), F.col("a")).when(F.col("sb") > F.col("sa"), F.col("b")).alias("larger"))


@query("balanced_questions")
def _(spark, sf):
    """Five questions for every answer; checked by its invariant and against a plain version in the tests."""
    return ge.balance(pairs(spark, sf))


# ---- token blocks ----


@query(
    "label_masks",
    r"""WITH d AS (SELECT doc_id, text, unnest(string_split(text, chr(10) || 'Q:')) AS part FROM documents WHERE text <> ''),
    p AS (SELECT doc_id, text, part, regexp_matches(part, '\n(?:A|Do):') AS said FROM d)
    SELECT doc_id, length(any_value(text)) AS n, CASE WHEN bool_or(said) THEN sum(CASE WHEN said THEN length(regexp_replace(part, '(?s)^.*?\n(?:A|Do):', '')) ELSE 0 END) ELSE length(any_value(text)) END::BIGINT AS n_trained FROM p GROUP BY doc_id""",
)
def _(spark, sf):
    """Code points stand for token ids."""
    ids = F.transform(F.split("text", ""), lambda x: F.ascii(x))
    d = documents(spark, sf).where("text <> ''").select("doc_id", ids.alias("ids"))
    labels = pk.label_mask(d, "ids", [[10, 65, 58], [10, 68, 111, 58]], [81, 58], [10, 81, 58])
    return labels.select("doc_id", F.size("ids").cast("long").alias("n"), F.size(F.filter("labels", lambda x: x != pk.IGNORED)).cast("long").alias("n_trained"))


@query(
    "chunked_blocks",
    """, t AS (SELECT doc_id, doc_id % 16 AS batch, regexp_extract_all(text, '[0-9]{1,4}') AS ids FROM documents WHERE text IS NOT NULL),
    u AS (SELECT batch, doc_id, unnest(ids)::INT AS id, generate_subscripts(ids, 1) AS k FROM t), r AS (SELECT batch, id, row_number() OVER (PARTITION BY batch ORDER BY doc_id, k) - 1 AS p, count(*) OVER (PARTITION BY batch) AS n FROM u)
    SELECT batch, (p // 128)::INT AS block_no, list(id ORDER BY p) AS input_ids FROM r WHERE p < n // 128 * 128 GROUP BY 1, 2""".replace(", t AS", "WITH t AS", 1),
)
def _(spark, sf):
    ids = F.transform(F.regexp_extract_all("text", F.lit("([0-9]{1,4})"), F.lit(1)), lambda x: x.cast("int"))
    d = documents(spark, sf).where("text is not null").select("doc_id", (F.col("doc_id") % 16).alias("batch"), ids.alias("ids"))
    return pk.chunk(d, "batch", "doc_id", "ids", 128)


@query(
    "packed_entries",
    """, t AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[0-9]{1,4}'), lambda x: x::INT) AS ids FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, list_concat(ids[1:32], list_transform(range(0, greatest(32 - len(ids), 0)), lambda x: 0::INT)) AS input_ids,
    CASE WHEN len(ids) < 32 THEN list_concat(list_append(ids, 0), list_transform(range(0, 31 - len(ids)), lambda x: (-100)::INT)) ELSE ids[1:32] END AS labels FROM t WHERE len(ids) > 0""".replace(", t AS", "WITH t AS", 1),
)
def _(spark, sf):
    ids = F.transform(F.regexp_extract_all("text", F.lit("([0-9]{1,4})"), F.lit(1)), lambda x: x.cast("int"))
    d = documents(spark, sf).where("text is not null").select("doc_id", ids.alias("ids")).withColumn("labels", F.col("ids"))
    return pk.pack_entries(d, "ids", "labels", 32, 0)


@query("token_blocks")
def _(spark, sf):
    """The answers of each path as ids of a public vocabulary, in blocks of 128; SQL has no tokenizer."""
    a = answers(spark, sf).where("a is not null and path is not null").groupBy("path", "line_no").agg(F.min("a").alias("a"))
    return pk.chunk(tk.tokenize(a, "a", VOCABULARY_FILE), "path", "line_no", "ids", 128)


@query("tokenized_answers")
def _(spark, sf):
    """Ids of every answer, the first 110 of them; checked against the public library in the tests."""
    return tk.tokenize(answers(spark, sf).select("answer_id", "a"), "a", VOCABULARY_FILE, longest=110).select("answer_id", "ids")


@query("train_eval_split")
def _(spark, sf):
    """By hash, so SQL of another engine can't repeat it; the tests check that it is stable and close to the share."""
    return documents(spark, sf).select("doc_id", ge.split_of(F.col("doc_id"), 50).alias("part"))


@query("seeded_shuffle")
def _(spark, sf):
    return answers(spark, sf).select("answer_id", F.xxhash64("answer_id", F.lit(42)).alias("place")).orderBy("place", "answer_id")


@query("capped_rows", "SELECT block_id, n FROM (SELECT block_id, greatest(1, length(coalesce(a, '')) // 4) AS n FROM B) ORDER BY n DESC, block_id LIMIT 100", "B")
def _(spark, sf):
    return blocks(spark, sf).select("block_id", rough_tokens(F.coalesce("a", F.lit(""))).alias("n")).orderBy(F.desc("n"), "block_id").limit(100)



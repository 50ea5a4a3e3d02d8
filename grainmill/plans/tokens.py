"""Tokenizer files, word lists, source scans and windows of time, on files written from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainmill import streaming as st
from grainmill.functions.text import unescape_token
from grainmill.plans.base import blocks, query, table
from grainmill.sources import text as src

# Files as a user has them, written from the tables: a tokenizer file whose tokens are the keywords of the rules and
# those of their pieces, source code that registers commands, and a word list for each topic.


def _tokenizer(spark, sf):
    """One JSON text: letters first, then each nation's name letter by letter as merges, then added tokens for the regions."""
    n = table(spark, sf, "nation").select(F.lower("n_name").alias("w"), "n_nationkey")
    letters = n.select(F.explode(F.split("w", "")).alias("t")).where("t <> ''").distinct().select("t", F.ascii("t").alias("id"))
    steps = n.select("n_nationkey", F.explode(F.sequence(F.lit(2), F.length("w"))).alias("i"), "w")
    merged = steps.select(F.expr("substring(w, 1, i)").alias("t"), F.expr("substring(w, 1, i - 1)").alias("l"), F.expr("substring(w, i, 1)").alias("r"), "n_nationkey", "i")
    more = merged.select("t", (F.lit(1000) + F.col("n_nationkey") * 100 + F.col("i")).alias("id")).groupBy("t").agg(F.min("id").alias("id"))
    vocab = letters.unionByName(more).agg(F.map_from_entries(F.collect_list(F.struct("t", F.col("id").cast("int")))).alias("vocab"))
    rules = merged.agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "i", "l", "r"))), lambda x: F.concat(x["l"], F.lit(" "), x["r"])).alias("merges"))
    added = table(spark, sf, "region").agg(F.collect_list(F.struct((F.lit(9000) + F.col("r_regionkey")).cast("int").alias("id"), F.concat(F.lit("<"), F.col("r_name"), F.lit(">")).alias("content"))).alias("added_tokens"))
    model = vocab.join(rules, F.lit(True)).join(added, F.lit(True))  # one row each
    return model.select(F.lit("f").alias("path"), F.to_json(F.struct(F.struct("vocab", "merges").alias("model"), "added_tokens")).alias("text"))


_TOKENS = """n AS (SELECT lower(n_name) AS w, n_nationkey AS k FROM nation), s AS (SELECT w, k, unnest(range(2, length(w) + 1)) AS i FROM n),
    m AS (SELECT k, i, substr(w, 1, i) AS t, substr(w, 1, i - 1) AS l, substr(w, i, 1) AS r FROM s),
    v AS (SELECT DISTINCT unnest(string_split(w, '')) AS token, NULL AS id FROM n), vo AS (SELECT token, ord(token)::INT AS id FROM v WHERE token <> '' UNION ALL SELECT t, min(1000 + k * 100 + i)::INT FROM m GROUP BY t),
    a AS (SELECT token, id FROM vo UNION ALL SELECT '<' || r_name || '>', (9000 + r_regionkey)::INT FROM region)"""


@query("tokenizer_vocab", f"WITH {_TOKENS} SELECT token, id FROM a")
def _(spark, sf):
    return src.tokenizer_vocab(_tokenizer(spark, sf))


@query(
    "tokenizer_merges",
    f"WITH {_TOKENS}, o AS (SELECT (row_number() OVER (ORDER BY k, i) - 1)::INT AS ord, l, r, t FROM m) SELECT ord, x.id AS left_id, y.id AS right_id, z.id AS new_id FROM o JOIN a x ON x.token = l JOIN a y ON y.token = r JOIN a z ON z.token = t WHERE l NOT LIKE '% %'",
)
def _(spark, sf):
    """A rule whose parts hold blanks can't be read back and drops out."""
    return src.tokenizer_merges(_tokenizer(spark, sf))


@query("plain_tokens", f"WITH {_TOKENS} SELECT replace(token, '<', ' ') AS token, id FROM a")
def _(spark, sf):
    """Tokens with the sign for a blank, as a byte-level vocabulary has them."""
    v = src.tokenizer_vocab(_tokenizer(spark, sf)).withColumn("token", F.replace("token", F.lit("<"), F.lit("Ġ")))
    return v.select(unescape_token("token").alias("token"), "id")


@query("tokenizer_stats", f"WITH {_TOKENS} SELECT (SELECT count(*) FROM a) AS n_tokens, (SELECT max(length(token)) FROM a) AS longest, (SELECT count(*) FROM m WHERE l NOT LIKE '% %') AS n_merges")
def _(spark, sf):
    t = _tokenizer(spark, sf)
    v = src.tokenizer_vocab(t).agg(F.count("*").alias("n_tokens"), F.max(F.length("token")).alias("longest"))
    return v.join(src.tokenizer_merges(t).agg(F.count("*").alias("n_merges")), F.lit(True))  # one row each


_CODE = """c AS (SELECT topic, unnest(keywords) AS w FROM topic_rules)"""


def _code(spark, sf):
    """Source code for each topic: the first keyword as a call, the others as a table, and all of them as a list."""
    quoted = lambda f: F.array_join(F.transform("keywords", f), ", ")
    call = F.concat(F.lit('registerCommand("'), F.get("keywords", F.lit(0)), F.lit('", run);\n'))
    rows = F.concat(F.lit("table[] = { "), quoted(lambda w: F.concat(F.lit('{ "'), w, F.lit('", 1}'))), F.lit(" };\n"))
    words = F.concat(F.lit("special = ["), quoted(lambda w: F.concat(F.lit('"'), w, F.lit('"'))), F.lit("]"))
    return table(spark, sf, "topic_rules").select(F.col("topic").alias("path"), F.concat(call, rows, words).alias("text"))


@query("source_commands", f"WITH {_CODE} SELECT DISTINCT w AS command FROM c WHERE regexp_matches(w, '^[a-z][a-z0-9_ ]+$') AND length(w) BETWEEN 2 AND 40")
def _(spark, sf):
    return src.source_commands(_code(spark, sf))


@query("list_literal", "SELECT (unnest(range(len(keywords))))::INT AS ord, unnest(keywords) AS entry FROM topic_rules")
def _(spark, sf):
    return src.list_literal(_code(spark, sf), "special")


def _lists(spark, sf):
    """A word list for each topic: a heading, the keywords, then a blank line and the topic in capitals."""
    t = F.concat(F.lit("# "), "topic", F.lit("\n"), F.array_join("keywords", "\n"), F.lit("\n\n "), F.upper("topic"), F.lit("\n"))
    return table(spark, sf, "topic_rules").select(F.col("topic").alias("path"), t.alias("text"))


_LISTS = "l AS (SELECT unnest(keywords) AS w, generate_subscripts(keywords, 1) + 1 AS ord FROM topic_rules UNION ALL SELECT upper(topic), len(keywords) + 3 FROM topic_rules)"


@query("word_list", f"WITH {_LISTS} SELECT lower(w) AS word, min(ord)::INT AS ord FROM l GROUP BY 1")
def _(spark, sf):
    return src.word_list(_lists(spark, sf))


@query("special_tokens", f"WITH {_LISTS} SELECT w AS word, min(ord)::INT AS ord FROM l GROUP BY 1")
def _(spark, sf):
    return src.word_list(_lists(spark, sf), keep_case=True)


@query("forced_words", f"WITH {_LISTS}, f AS (SELECT DISTINCT unnest(regexp_extract_all(lower(w), '[a-z0-9]+')) AS word FROM l) SELECT word FROM f WHERE length(word) >= 3 AND NOT regexp_matches(word, '^[0-9]+$')")
def _(spark, sf):
    return src.forced_words(_lists(spark, sf))


@query("events_by_day", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, sf):
    return st.windowed_counts(table(spark, sf, "events"), "ts", "event_type")


@query("deliveries", "SELECT block_id, count(*) AS n, max(ingested_at) AS last_at FROM blocks GROUP BY block_id HAVING count(*) > 1")
def _(spark, sf):
    b = table(spark, sf, "blocks").groupBy("block_id").agg(F.count("*").alias("n"), F.max("ingested_at").alias("last_at"))
    return b.where("n > 1")


@query("blocks_by_path", "SELECT path, type, count(*) AS n FROM B GROUP BY path, type", "B")
def _(spark, sf):
    return blocks(spark, sf).groupBy("path", "type").agg(F.count("*").alias("n"))


@query("presets", "SELECT preset, vocab_size * n_embd AS embedding, n_layer * (4 * n_embd * n_embd + 2 * n_embd * n_inner) AS layers, 2 * n_layer * n_embd * seq_len AS kv_cache, n_embd % n_head = 0 AS heads_fit FROM presets")
def _(spark, sf):
    p = table(spark, sf, "presets")
    return p.selectExpr("preset", "vocab_size * n_embd as embedding", "n_layer * (4 * n_embd * n_embd + 2 * n_embd * n_inner) as layers", "2 * n_layer * n_embd * seq_len as kv_cache", "n_embd % n_head = 0 as heads_fit")

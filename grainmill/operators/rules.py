"""Joins of texts with rule tables: substring, regex and prefix rules.

A rule table is small next to the corpus but nothing proves how small: it is sent to the executors in blocks of at most
RULES_PER_BLOCK rules, each block in a pass of its own over the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES_PER_BLOCK = 5_000
#: Up to so many regex rules become literals of one expression.
LITERAL_RULES = 100


def match(texts: DataFrame, rules: DataFrame, condition: Column) -> DataFrame:
    """Every text with every rule whose condition holds."""
    n = rules.count()
    if n <= RULES_PER_BLOCK:
        return texts.join(F.broadcast(rules), condition)
    from grainmill.session import materialize

    blocks = -(-n // RULES_PER_BLOCK)
    cut = materialize(rules.withColumn("_b", F.pmod(F.xxhash64(*rules.columns), F.lit(2 * blocks))), "rules")
    out = None
    for b in range(2 * blocks):  # blocks by hash, on average half full
        part = texts.join(F.broadcast(cut.where(F.col("_b") == b).drop("_b")), condition)
        out = part if out is None else out.unionByName(part)
    return out


def contains(text: Column | str, term: Column | str) -> Column:
    """Letter case ignored."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.contains(F.lower(c(text)), F.lower(c(term)))


def term_or_word(text: str, term: str, whole_word: str) -> Column:
    """Case-sensitive: as a whole word (no ASCII letter, digit or _ beside it) or anywhere."""
    word = F.concat(F.lit(r"(^|[^A-Za-z0-9_])\Q"), F.col(term), F.lit(r"\E($|[^A-Za-z0-9_])"))
    return F.when(F.col(whole_word), F.rlike(F.col(text), word)).otherwise(F.contains(F.col(text), F.col(term)))


def first_prefix(texts: DataFrame, key: list[str], text: str, rules: DataFrame, prefix: str = "prefix", order: str = "ord") -> DataFrame:
    """(key, text, prefix): the first rule in order whose prefix begins the text, letter case ignored; at most one for each text."""
    hit = match(texts.select(*key, text), rules, F.startswith(F.lower(F.col(text)), F.lower(F.col(prefix))))
    return hit.groupBy(*key, text).agg(F.min_by(prefix, order).alias(prefix))


def topics(texts: DataFrame, key: list[str], text: Column, rules: DataFrame) -> DataFrame:
    """(key, topic): each topic with at least one keyword (a regex, letter case ignored) in the text, once."""
    one = rules.where(F.size("keywords") > 0).select("topic", F.concat(F.lit("(?i)"), F.array_join("keywords", "|")).alias("_re"))
    t = texts.select(*key, text.alias("_t")).where("_t is not null")
    few = one.orderBy("topic", "_re").limit(LITERAL_RULES + 1).collect()
    if len(few) <= LITERAL_RULES:  # a pattern that is a literal is compiled once, not for every row
        hits = F.array(*[F.when(F.rlike("_t", F.lit(r["_re"])), F.lit(r["topic"])) for r in few]) if few else F.array().cast("array<string>")
        return t.select(*key, F.explode(F.array_distinct(F.array_compact(hits))).alias("topic"))
    return match(t, one, F.expr("rlike(_t, _re)")).select(*key, "topic").distinct()


def set_differences(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """(key, only_left, only_right, both, differs): the sets of values that two sources have for each key; null keys are left out.

    Values are counted by (key, value) first, so a key with very many of them is spread, and no set is built.
    """
    side = lambda d, n: d.where(F.col(key).isNotNull()).select(key, value, F.lit(n).alias("_s"))
    one = side(left, 1).unionByName(side(right, 2)).groupBy(key, value).agg(F.bit_or("_s").alias("_s"))
    n = lambda x: F.count_if(F.col("_s") == x)
    return one.groupBy(key).agg(n(1).alias("only_left"), n(2).alias("only_right"), n(3).alias("both"), (n(3) < F.count("*")).alias("differs"))

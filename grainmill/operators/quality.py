"""Checks of lines, answers, commands and prose; each gives rows or flags, never prints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions.text import n_tokens, rough_tokens, strip, tokens


def length_flag(a: str = "a", least: int = 10, most: int = 300) -> Column:
    """short, long or null by characters."""
    return F.when(F.length(a) < least, "short").when(F.length(a) > most, "long")


def over_budget(q: str, a: str, text: str, budget: int = 110) -> Column:
    """Rough tokens of "Q: q\\nA: a" or of the prose, if above the budget; else null."""
    t = F.when(F.col(q).isNotNull() & F.col(a).isNotNull(), F.concat(F.lit("Q: "), F.col(q), F.lit("\nA: "), F.col(a))).otherwise(F.col(text))
    n = rough_tokens(t)
    return F.when(n > budget, n)


def command_flags(do: str = "do") -> Column:
    """What looks wrong with a command: many_words, verb_led, sentence; an empty array if nothing."""
    d = F.col(do)
    return F.array_compact(
        F.array(
            F.when(n_tokens(d) > 3, F.lit("many_words")),
            F.when(d.startswith("Type ") | d.startswith("Use "), F.lit("verb_led")),
            F.when(F.contains(d, F.lit(".")) & (F.length(d) > 20), F.lit("sentence")),
        )
    )


def broken_line(line: str, prev: str) -> Column:
    """A fragment: begins in lower case after a blank line, is short and has no end mark."""
    return (F.coalesce(strip(prev), F.lit("")) == "") & F.col(line).rlike("^[a-z]") & (F.length(line) < 30) & ~F.col(line).rlike("[.!?]")


#: Words with which a good question doesn't end.
WEAK_ENDINGS = "the a an to of for with in on is are do can i my not this that".split()


def question_quality(q: str = "q") -> Column:
    """The first reason to reject a question, or null: too_short, weak_ending, repeated_words, vague_subject, bare_can_i."""
    s = strip(F.regexp_replace(F.lower(F.col(q)), r"\?+$", ""))
    w = tokens(s)
    return (
        F.when(F.size(w) < 2, "too_short")
        .when(F.element_at(w, -1).isin(WEAK_ENDINGS), "weak_ending")
        .when((F.size(w) < 5) & (F.size(F.array_distinct(w)) < F.size(w)), "repeated_words")
        .when(s.rlike(r"^(?:explain|describe|can you describe|tell me about) (?:many|only|there|here|where|much|very|just|also|even)(?:$|[^a-z0-9_])"), "vague_subject")
        .when(s.rlike(r"^can i (?:there|this|that|here|only|many)$"), "bare_can_i")
    )


def part_numbers(lines: DataFrame, key: list[str], text: str, known: DataFrame, excluded: DataFrame) -> DataFrame:
    """(key, part): part numbers (2 to 5 capitals, 3 to 5 digits, perhaps a capital) in neither list of (part)."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"(?:^|[^A-Za-z0-9_])([A-Z]{2,5}[0-9]{3,5}[A-Z]?)(?![A-Za-z0-9_])"), F.lit(1))
    p = lines.select(*key, F.explode(F.array_distinct(found)).alias("part")).distinct()
    return p.join(known.select("part"), "part", "left_anti").join(excluded.select("part"), "part", "left_anti").select(*key, "part")


#: Openings of answers that turn a question down as off topic.
OFF_TOPIC = ("I can only answer", "I can only help", "I have no internet", "I cannot", "I run entirely")


def off_topic(a: str = "a") -> Column:
    hit = F.lit(False)
    for x in OFF_TOPIC:
        hit = hit | F.contains(F.col(a), F.lit(x))
    return F.coalesce(hit, F.lit(False))


def issues(blocks: DataFrame) -> DataFrame:
    """(block_id, issue): every issue of every block, from one pass over the blocks."""
    body = F.coalesce("a", "do")
    found = F.array_compact(
        F.array(
            F.when(F.col("type") == "qa", F.concat_ws("_", length_flag(), F.lit("answer"))),
            F.when(over_budget("q", "a", "text").isNotNull(), F.lit("over_budget")),
            F.when((F.col("type") == "do") & (F.size(command_flags()) > 0), F.lit("odd_command")),
            F.when((F.col("type") == "prose") & (n_tokens("text") < 10), F.lit("short_prose")),
            F.when((F.col("type") == "prose") & (n_tokens("text") > 55), F.lit("long_prose")),
            F.when(F.col("type").startswith("orphan"), F.col("type")),
            F.when(F.col("type").isin("qa", "do") & (F.coalesce(strip(body), F.lit("")) == ""), F.lit("blank_response")),
            F.when(question_quality().isNotNull(), F.concat(F.lit("question_"), question_quality())),
        )
    )
    return blocks.select("block_id", F.explode(F.filter(found, lambda x: x != "answer")).alias("issue"))


def gates(counts: DataFrame, checks: list[str], issue: str = "issue", n: str = "n") -> DataFrame:
    """(check, n_issues, passed): one row for each named check, with 0 where nothing was found."""
    names = counts.sparkSession.createDataFrame([(c,) for c in checks], "check string")
    j = names.join(counts.withColumnRenamed(issue, "check"), "check", "left")
    return j.select("check", F.coalesce(n, F.lit(0)).cast("long").alias("n_issues")).withColumn("passed", F.col("n_issues") == 0)

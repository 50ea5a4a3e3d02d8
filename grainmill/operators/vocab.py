"""Domain vocabulary and word sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.functions.text import gate_tokens


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of a-z0-9 words, lower-cased."""
    return texts.select(F.explode(gate_tokens(text)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def domain_vocabulary(
    counts: DataFrame, stopwords: DataFrame, forced: DataFrame, common: DataFrame | None = None, min_count: int = 2, min_len: int = 3, max_words: int = 600
) -> DataFrame:
    """(word, n): words worth a place of their own, at most ``max_words``, by falling count, then by word.

    Kept: at least ``min_count`` times, ``min_len`` characters, not all digits, no stopword. ``forced`` words come in
    whatever their count (1 if they don't occur). ``common``, if given, is taken out of the others.
    """
    fit = lambda d: d.where((F.length("word") >= min_len) & ~F.col("word").rlike("^[0-9]+$"))
    kept = fit(counts).where(F.col("n") >= min_count).join(stopwords.select("word"), "word", "left_anti")
    if common is not None:
        kept = kept.join(common.select("word"), "word", "left_anti")
    more = fit(forced.select("word").distinct()).join(kept.select("word"), "word", "left_anti").join(counts, "word", "left")
    return kept.select("word", "n").unionByName(more.select("word", F.coalesce("n", F.lit(1)).cast("long").alias("n"))).orderBy(F.desc("n"), "word").limit(max_words)


def token_candidates(words: DataFrame, tokens: DataFrame, common: DataFrame, least: int = 5) -> DataFrame:
    """(word): words in lower-case letters, long enough, not common, and not yet a token in either letter case."""
    w = words.where((F.length("word") >= least) & F.col("word").rlike("^[a-z]+$")).select("word").distinct()
    have = tokens.select(F.lower("token").alias("word")).distinct()
    return w.join(common.select("word"), "word", "left_anti").join(have, "word", "left_anti")


def ordered_distinct(df: DataFrame, value: str, order: str) -> DataFrame:
    """(value, first): every value once, with its first place."""
    return df.groupBy(value).agg(F.min(order).alias("first"))


def fragmented(terms: DataFrame, vocabulary: str, term: str = "term") -> DataFrame:
    """(term, bare, spaced): terms that a public byte-level vocabulary cuts into several tokens both bare and after a blank.

    ``vocabulary`` is the path of a rank file; null terms are left out. Terms are encoded in batches, each once.
    """

    def run(batches):
        import base64

        import pandas as pd
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("terms", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            t = b["term"]
            yield pd.DataFrame({"term": t, "bare": [len(enc.encode_ordinary(x)) for x in t], "spaced": [len(enc.encode_ordinary(" " + x)) for x in t]})

    one = terms.where(F.col(term).isNotNull()).select(F.col(term).alias("term")).distinct()
    return one.mapInPandas(run, "term string, bare int, spaced int").where("bare <> 1 and spaced <> 1")

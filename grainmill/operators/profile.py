"""Profiles of a corpus: frequencies, histograms, n-grams, budgets, lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.text import n_tokens, ngrams, strip, tokens


def frequency(df: DataFrame, value: str, order: str | None = None) -> DataFrame:
    """(value, n[, first]): how often every value that isn't null or blank occurs, and the least ``order`` of it."""
    v = df.where(strip(value) != "").groupBy(value)
    return v.agg(F.count("*").alias("n"), *([F.min(order).alias("first")] if order else []))


def histogram(freq: DataFrame, n: str = "n") -> DataFrame:
    """(n, values): how many values occur n times."""
    return freq.groupBy(n).agg(F.count("*").alias("values"))


def frequency_summary(freq: DataFrame, n: str = "n") -> DataFrame:
    """One row (total, distinct_values, most, least, median): median is the element at half the length of the falling list.

    It is read off the histogram, which has at most as many rows as the square root of twice the total. An empty
    table gives zeros and nulls.
    """
    h = histogram(freq, n)
    w = Window.orderBy(F.desc(n)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = h.select(F.col(n).alias("n"), "values", F.sum("values").over(w).alias("upto"), F.sum("values").over(Window.partitionBy()).alias("d"))
    return cum.agg(
        F.coalesce(F.sum(F.col("n") * F.col("values")), F.lit(0)).cast("long").alias("total"),
        F.coalesce(F.max("d"), F.lit(0)).cast("long").alias("distinct_values"),
        F.max("n").alias("most"),
        F.min("n").alias("least"),
        F.max(F.when(F.col("upto") > F.floor(F.col("d") / 2), F.col("n"))).alias("median"),
    )


def word_budget(freq: DataFrame, value: str, n: str = "n") -> DataFrame:
    """(value, n, words, budget): copies times words."""
    return freq.select(value, n, n_tokens(value).alias("words")).withColumn("budget", F.col(n) * F.col("words"))


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows in a total order."""
    return df.orderBy(*order).limit(k)


def ngram_frequency(df: DataFrame, text: str, size: int) -> DataFrame:
    """(ngram, n) of lower-cased words between white space, every occurrence counted. Linear in the length of a text."""
    words = df.select(tokens(F.lower(F.col(text))).alias("_w"))  # a column of its own: a lambda would split the text again for every n-gram
    return words.select(F.explode(ngrams(F.col("_w"), size)).alias("ngram")).groupBy("ngram").agg(F.count("*").alias("n"))


def length_stats(df: DataFrame, by: str, text: str) -> DataFrame:
    """(by, n, avg_words, min_words, max_words) of texts that aren't null."""
    w = df.where(F.col(text).isNotNull()).select(by, n_tokens(text).alias("w"))
    return w.groupBy(by).agg(F.count("*").alias("n"), F.avg("w").alias("avg_words"), F.min("w").alias("min_words"), F.max("w").alias("max_words"))


def numeric_stats(df: DataFrame, by: str, values: str) -> DataFrame:
    """(by, n, lo, hi, mean, std, n_nan, zero_share, degenerate) of arrays of numbers, element by element.

    degenerate: a NaN, a deviation below 1e-6 or more than 90 % zeros.
    """
    x = df.select(by, F.explode(values).alias("x")).withColumn("x", F.col("x").cast("double"))
    s = x.groupBy(by).agg(
        F.count("x").alias("n"),
        F.min("x").alias("lo"),
        F.max("x").alias("hi"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.count_if(F.isnan("x")).alias("n_nan"),
        (F.count_if(F.col("x") == 0) / F.count("x")).alias("zero_share"),
    )
    return s.withColumn("degenerate", (F.col("n_nan") > 0) | (F.col("std") < 1e-6) | (F.col("zero_share") > 0.9))


def series_summary(df: DataFrame, by: str, order: list[str], value: str) -> DataFrame:
    """(by, first, last, least, at_least) of a logged series; ``at_least`` is the order of the least value, the earliest of ties."""
    o = F.struct(*order)
    return df.groupBy(by).agg(
        F.min_by(value, o).alias("first"),
        F.max_by(value, o).alias("last"),
        F.min(value).alias("least"),
        F.min(F.struct(F.col(value), *order))[order[0]].alias("at_least"),
    )

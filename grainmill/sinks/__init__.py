"""Writing corpora, word lists, reports, sessions and tokenizer blocks. Every sink writes to a new path."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.operators.similarity import apply_map


def block_text(q: str = "q", a: str = "a", do: str = "do", text: str = "text") -> Column:
    """A block as corpus text: question and response lines, or the prose; null if there is nothing."""
    c = lambda label, x: F.when(F.col(x).isNotNull(), F.concat(F.lit(label), F.col(x)))
    return F.nullif(F.concat_ws("\n", c("Q: ", q), c("A: ", a), c("Do: ", do), F.col(text)), F.lit(""))


def shuffled(df: DataFrame, *key: str, seed: int = 42) -> DataFrame:
    """The rows in an order that looks random and is the same on every run."""
    return df.orderBy(F.xxhash64(*key, F.lit(seed)), *key)


def write_corpus(blocks: DataFrame, path: str, *key: str, seed: int | None = 42) -> None:
    """Blocks as text, one blank line between; shuffled by the key unless the seed is None. Empty blocks are left out."""
    rows = blocks.withColumn("value", block_text()).where("value is not null")
    rows = shuffled(rows, *key, seed=seed) if seed is not None else rows.orderBy(*key)
    rows.select("value").write.text(path, lineSep="\n\n")


def rewrite_lines(lines: DataFrame, mapping: DataFrame, path: str, key: str = "path", order: str = "line_no", line: str = "line") -> None:
    """Lines with the answers of "A: " lines replaced by the map (a, to), one folder for each key.

    The files of a folder, in order of their names, hold its lines in order; a folder with very many lines is written
    by several tasks.
    """
    body = F.when(F.col(line).startswith("A: "), F.trim(F.substring(line, 4, 1 << 30)))
    j = apply_map(lines.withColumn("_a", body), mapping.select(F.col("a").alias("_a"), "to"), "_a", "to")
    out = j.select(key, order, F.when(F.col("changed"), F.concat(F.lit("A: "), F.col("_a"))).otherwise(F.col(line)).alias("value"))
    out.repartitionByRange(key, order).sortWithinPartitions(key, order).select(key, "value").write.partitionBy(key).text(path)


def changelog(merged: DataFrame, trimmed: DataFrame) -> DataFrame:
    """(reason, a, to) of two rewrite maps (a, to), and both composed where one follows the other."""
    t = trimmed.select(F.col("a").alias("_m"), F.col("to").alias("_t"))
    one = merged.join(t, merged["to"] == F.col("_m"), "left").select(
        F.when(F.col("_t").isNull(), "merged").otherwise("merged and trimmed").alias("reason"), "a", F.coalesce("_t", "to").alias("to")
    )
    rest = trimmed.join(merged.select("a"), "a", "left_anti").select(F.lit("trimmed").alias("reason"), "a", "to")
    return one.unionByName(rest)


def write_review(found: DataFrame, path: str) -> None:
    """The review list (section, place, line) of ``similarity.review`` as text, clusters first, a heading before each."""
    head = F.concat(F.lit("### "), F.initcap("section"), F.lit(" "), F.col("place").cast("string"), F.lit("\n"), F.col("line"))
    found.orderBy("section", "place").select(head.alias("value")).write.text(path, lineSep="\n\n")


def write_word_list(words: DataFrame, path: str, header: list[str], word: str = "word") -> None:
    """A sorted word list, one entry a line, with # lines before the first."""
    h = words.sparkSession.createDataFrame([(0, i, "# " + x) for i, x in enumerate(header)], "a int, i int, value string")
    w = words.select(F.lit(1).alias("a"), F.lit(0).alias("i"), F.col(word).alias("value"))
    h.unionByName(w).orderBy("a", "i", "value").select("value").write.text(path)


def write_token_list(tokens: DataFrame, path: str, token: str = "token", order: str = "ord") -> None:
    """Special tokens in order of first appearance, each once."""
    tokens.groupBy(token).agg(F.min(order).alias("o")).orderBy("o", token).select(F.col(token).alias("value")).write.text(path)


def write_sessions(sessions: DataFrame, path: str, slug: str = "slug", order: str = "line_no", line: str = "line") -> None:
    """The lines of each session in a folder of its own, in order of its files' names."""
    sessions.repartitionByRange(slug, order).sortWithinPartitions(slug, order).select(slug, F.col(line).alias("value")).write.partitionBy(slug).text(path)


def tokenizer_block(vocab: DataFrame, merges: DataFrame) -> bytes:
    """A compact little-endian block: sizes, then each token in order of id as length and UTF-8 bytes, then merges as three ids.

    Lengths are one byte (longer tokens are cut at 255 bytes), all other numbers 32 bits. A vocabulary is as small as
    a tokenizer file, so it is put together on the driver; ids without a token get empty entries.
    """
    v = vocab.where("id is not null").toPandas()
    m = merges.orderBy("ord").toPandas()
    n = int(v["id"].max()) + 1 if len(v) else 0
    by_id = dict(zip(v["id"], v["token"]))
    out = [struct.pack("<II", n, len(m))]
    for i in range(n):
        b = (by_id.get(i) or "").encode()[:255]
        out.append(struct.pack("<B", len(b)) + b)
    out += [struct.pack("<III", *map(int, r)) for r in m[["left_id", "right_id", "new_id"]].itertuples(index=False)]
    return b"".join(out)


def tokenizer_stats(vocab: DataFrame, merges: DataFrame) -> pd.DataFrame:
    """One row (n_tokens, n_merges, longest)."""
    s = vocab.agg(F.count("*").alias("n_tokens"), F.max(F.length("token")).alias("longest")).toPandas()
    return s.assign(n_merges=merges.count())

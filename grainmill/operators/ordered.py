"""Operators on ordered rows that don't put all rows of one key into one task.

A key (a path, a source) may hold a third of all rows. Its order numbers are therefore cut into chunks: windows run
inside (key, chunk), and only one row of each chunk takes part in a window over the whole key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 50_000


def running_sum(df: DataFrame, key: str, order: str, value: Column, name: str, chunk: int = CHUNK, levels: int = 2) -> DataFrame:
    """Adds the sum of ``value`` over the rows of the key up to this one (order numbers unique in a key).

    The sums of the chunks are summed up in the same way, so of a key of N rows one task sees N / chunk^levels.
    """
    c = df.withColumn("_c", F.floor(F.col(order) / chunk)).withColumn("_v", F.coalesce(value, F.lit(0)).cast("long"))
    inside = Window.partitionBy(key, "_c").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = c.groupBy(key, "_c").agg(F.sum("_v").alias("_t"))
    if levels > 1:
        upto = running_sum(totals.withColumnRenamed("_c", "_o").withColumnRenamed("_t", "_w"), key, "_o", F.col("_w"), "_u", chunk, levels - 1)
        before = upto.select(key, F.col("_o").alias("_c"), (F.col("_u") - F.col("_w")).alias("_b"))
    else:
        before = totals.withColumn("_b", F.coalesce(F.sum("_t").over(Window.partitionBy(key).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    local = c.withColumn("_s", F.sum("_v").over(inside))
    joined = local.join(before.select(key, "_c", "_b"), [key, "_c"])
    return joined.withColumn(name, F.col("_s") + F.col("_b")).drop("_c", "_v", "_s", "_b")


def neighbours(df: DataFrame, key: str, order: str, values: list[str], chunk: int = CHUNK) -> DataFrame:
    """Adds prev_ and next_ of every value: those of the row before and after in the key, null at its ends."""
    c = df.withColumn("_c", F.floor(F.col(order) / chunk))
    w = Window.partitionBy(key, "_c").orderBy(order)
    row = F.struct(*values)
    local = c.withColumn("_p", F.lag(row).over(w)).withColumn("_n", F.lead(row).over(w))
    ends = c.groupBy(key, "_c").agg(F.min_by(row, order).alias("_first"), F.max_by(row, order).alias("_last"))
    k = Window.partitionBy(key).orderBy("_c")
    ends = ends.select(key, "_c", F.lag("_last").over(k).alias("_pl"), F.lead("_first").over(k).alias("_nf"))
    j = local.join(ends, [key, "_c"])
    p, n = F.coalesce("_p", "_pl"), F.coalesce("_n", "_nf")
    return j.select(*df.columns, *[p[v].alias(f"prev_{v}") for v in values], *[n[v].alias(f"next_{v}") for v in values])


def line_neighbours(texts: DataFrame, key: str, lines: Column) -> DataFrame:
    """(key, line_no, line, prev, next): the lines of each text with those before and after, null at its ends.

    No window and no shuffle: a text's lines are one array, split once and read by place, so the work is linear.
    """
    ls = texts.select(key, lines.alias("_ls"))
    near = F.transform("_ls", lambda x, i: F.struct((i + 1).alias("line_no"), x.alias("line"), F.when(i > 0, F.get("_ls", i - 1)).alias("prev"), F.get("_ls", i + 1).alias("next")))
    return ls.select(key, F.explode(near).alias("_s")).select(key, "_s.*")


def sessions(lines: DataFrame, key: str = "path", order: str = "line_no", line: str = "line", marker: str = r'llm (?:ask|generate) ".*"') -> DataFrame:
    """Adds session: the number of marker lines up to this one; lines before the first marker are left out."""
    mark = F.coalesce(F.col(line).rlike(marker), F.lit(False)).cast("int")
    return running_sum(lines, key, order, mark, "session").where("session > 0")


def transitions(df: DataFrame, key: str, order: str, words: Column, least_shared: int = 3) -> DataFrame:
    """(key, n, changes): rows whose words share fewer than ``least_shared`` with those of the row before, if that had any."""
    near = neighbours(df.select(key, order, words.alias("w")), key, order, ["w"])
    change = (F.size("prev_w") > 0) & (F.size(F.array_intersect("w", "prev_w")) < least_shared)
    return near.groupBy(key).agg(F.count("*").alias("n"), F.count_if(change).alias("changes"))


def interleave(main: DataFrame, extra: DataFrame, order: str, n_main: int, n_extra: int) -> DataFrame:
    """Both tables as one with position ``pos``: the extra rows spread evenly among the main ones.

    ``order`` numbers the rows of each from 0. Extra row k follows main row floor((k + 1) * n_main / (n_extra + 1)).
    """
    m = main.withColumn("pos", F.col(order).cast("double"))
    e = extra.withColumn("pos", F.floor((F.col(order) + 1) * n_main / (n_extra + 1)) - 0.5 + F.col(order) / (2.0 * max(n_extra, 1)))
    return m.unionByName(e)

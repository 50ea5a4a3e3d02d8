"""Answers that nearly repeat, extend or contradict one another."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.text import body_of, lead_of, squeeze, tokens, verb_key, verb_led
from grainmill.operators.graph import connected_components, resolve_map
from grainmill.session import hot_split_join, materialize


#: Longs of a word set's bitmap.
LONGS = 4


def near_pairs(texts: DataFrame, text: str = "a", parts: int = 4, whole: int = 3) -> DataFrame:
    """(a, b, shared, smaller): pairs of different texts whose word sets overlap by at least whole/parts of the smaller.

    Word sets are lower-cased and split at white space; blank texts take no part. Every qualifying pair of texts of any
    length is found: two sets of sizes m <= n that share k >= whole/parts * m words must share one of the m - k + 1
    rarest words of the smaller one, so the smaller side is indexed by those only, the larger by all. Words that very
    many texts have are salted. a < b.
    """
    t = texts.select(F.trim(F.lower(F.col(text))).alias("t"), F.col(text).alias("x")).where("t <> ''").groupBy("x").agg(F.first("t").alias("t"))
    sets = t.select(F.col("x"), F.array_distinct(tokens("t")).alias("w")).withColumn("p", F.transform("w", lambda x: F.pmod(F.xxhash64(x), F.lit(64 * LONGS))))
    bits = [F.expr(f"aggregate(p, 0L, (a, x) -> if(x div 64 = {i}, a | shiftleft(1L, int(x % 64)), a))").alias(f"b{i}") for i in range(LONGS)]
    # the number is written with the row, so it stays the same
    sets = materialize(sets.select("x", "w", F.size("w").alias("m"), *bits, F.monotonically_increasing_id().alias("h")), "sets")
    df = sets.select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    # the words of the language are in very many sets: hot words are joined apart
    known = materialize(df.withColumn("n", F.col("df")), "df")
    posted = materialize(hot_split_join(sets.select("h", "m", F.explode("w").alias("word")), known, "word", "n"), "posted")
    ranked = posted.groupBy("h", "m").agg(F.array_sort(F.collect_list(F.struct("df", "word"))).alias("s"))
    need = F.ceil(F.col("m") * whole / parts)
    rare = ranked.select("h", F.explode(F.slice("s", F.lit(1), (F.col("m") - need + 1).cast("int"))).alias("s")).select("h", F.col("s.word").alias("word"), F.col("s.df").alias("df"))
    side = lambda k: [F.col(c).alias(c + k) for c in ("h", "m", *[f"b{i}" for i in range(LONGS)])]
    rare = rare.join(sets.select(*side("1")), F.col("h") == F.col("h1")).drop("h")
    # the larger set holds the word anywhere; sizes decide which side is the smaller, equal sizes by number
    every = sets.select(*side("2"), F.explode("w").alias("word"))
    # bits that only the smaller set has are words that the larger lacks: most pairs end here
    lacks = sum(F.bit_count(F.col(f"b{i}1").bitwiseAND(F.bitwise_not(f"b{i}2"))) for i in range(LONGS))
    met = hot_split_join(every, materialize(rare, "rare"), "word", "df", keep_key=False)
    cand = met.where((F.col("m1") < F.col("m2")) | ((F.col("m1") == F.col("m2")) & (F.col("h1") < F.col("h2")))).where((F.col("m1") - lacks) * parts >= F.col("m1") * whole).select("h1", "h2").distinct()
    a, b = sets.select(F.col("h").alias("h1"), F.col("x").alias("x1"), F.col("w").alias("w1")), sets.select(F.col("h").alias("h2"), F.col("x").alias("x2"), F.col("w").alias("w2"))
    j = cand.join(a, "h1").join(b, "h2").withColumn("shared", F.size(F.array_intersect("w1", "w2"))).withColumn("smaller", F.least(F.size("w1"), F.size("w2")))
    got = j.where(F.col("shared") * parts >= F.col("smaller") * whole)
    return got.select(F.least("x1", "x2").alias("a"), F.greatest("x1", "x2").alias("b"), F.col("shared").cast("long").alias("shared"), F.col("smaller").cast("long").alias("smaller"))


def divergent_groups(texts: DataFrame, text: str = "a", parts: int = 20, whole: int = 17) -> DataFrame:
    """(text, component): groups of bodies with overlap of at least whole/parts where neither begins with the other."""
    p = materialize(near_pairs(texts, text, parts, whole).where(~F.startswith(F.col("a"), F.col("b")) & ~F.startswith(F.col("b"), F.col("a"))), "near")
    ids = p.select(F.col("a").alias("x")).unionByName(p.select(F.col("b").alias("x"))).distinct().withColumn("id", F.xxhash64("x"))
    c = connected_components(p.select(F.xxhash64("a").alias("src"), F.xxhash64("b").alias("dst")))
    named = ids.join(c, ids["id"] == c["node"]).select("x", "component")
    least = named.groupBy("component").agg(F.min("x").alias("group"))
    return named.join(least, "component").select(F.col("x").alias(text), "group")


def canonical_merge(counts: DataFrame, text: str = "a", n: str = "n", order: str = "first") -> DataFrame:
    """(text, canonical): answers that are one command under several verbs, or differ in white space only.

    The key is the text after Type/Run/Use, or the squeezed text; verb-led and other texts never mix. Groups of one
    stay. The winner begins with Type, is most frequent, then shortest, then earliest; verb-led output begins with
    Type. Only texts that change are given.
    """
    t = counts.select(F.col(text).alias("x"), F.col(n).alias("n"), F.col(order).alias("o"), verb_led(text).alias("led"), verb_key(text).alias("key"))
    best = F.struct(squeeze("x").startswith("Type "), F.col("n"), F.negative(F.length("x")), F.negative("o"), F.col("x").alias("x"))
    g = t.groupBy("led", "key").agg(F.count("*").alias("k"), F.max(best).alias("w")).where("k > 1")
    won = g.select("led", "key", F.when(F.col("led"), F.concat(F.lit("Type "), F.col("key"))).otherwise(squeeze("w.x")).alias("canonical"))
    return t.join(won, ["led", "key"]).where("x <> canonical").select(F.col("x").alias(text), "canonical")


def core_of(counts: DataFrame, text: str = "a", least_words: int = 3) -> DataFrame:
    """(text, core): bodies that only add sentences to another body, mapped to the shortest such core, through chains.

    A core ends in a full stop, has at least three words and is followed by a blank. The sentence-end prefixes of each
    body meet the bodies by an equi-join, so no pair of bodies is compared.
    """
    b = counts.select(body_of(text).alias("x")).where("x <> ''").distinct()
    # split once at every full stop and blank; a core is the first pieces put together again
    pieces = b.select("x", F.split("x", r"(?<=\.) ").alias("p"))
    ends = pieces.where(F.size("p") > 1).select("x", "p", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("i"))
    pre = ends.select("x", F.array_join(F.slice("p", F.lit(1), F.col("i")), " ").alias("core")).where(F.size(tokens("core")) >= least_words)
    hit = pre.join(b.select(F.col("x").alias("core")), "core", "left_semi")
    first = hit.groupBy("x").agg(F.min_by("core", F.length("core")).alias("core"))
    return resolve_map(first, "x", "core").select(F.col("x").alias(text), "core")


def polarity_conflicts(texts: DataFrame, text: str = "a") -> DataFrame:
    """(body, yes, no): bodies stated both after Yes and after No, with how often."""
    t = texts.select(lead_of(text).alias("lead"), body_of(text).alias("body")).where("lead is not null")
    g = t.groupBy("body").agg(F.count_if(F.col("lead") == "Yes").alias("yes"), F.count_if(F.col("lead") == "No").alias("no"))
    return g.where("yes > 0 and no > 0")


def apply_map(df: DataFrame, mapping: DataFrame, column: str, to: str) -> DataFrame:
    """df with the column rewritten where the map has it; ``changed`` says where. Frequent values are salted."""
    n = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    m = materialize(mapping.select(column, F.col(to).alias("_to")).join(n, column), "map")
    return hot_split_join(df, m, column, "_n", "left").withColumn("changed", F.col("_to").isNotNull()).withColumn(column, F.coalesce("_to", column)).drop("_to")


def ranked_pairs(pairs: DataFrame) -> DataFrame:
    """(place, a, b, similarity): pairs of ``near_pairs`` by falling similarity, then falling texts.

    One range sort; the places come from the sizes of its ranges, not from a window over all rows.
    """
    p = pairs.select("a", "b", (F.col("shared") / F.col("smaller")).alias("similarity"))
    ranged = materialize(p.repartitionByRange(F.desc("similarity"), F.desc("a"), F.desc("b")).withColumn("_r", F.spark_partition_id()), "ranked")
    sizes = ranged.groupBy("_r").agg(F.count("*").alias("_n"))
    before = sizes.select("_r", (F.sum("_n").over(Window.orderBy("_r")) - F.col("_n")).alias("_b"))  # one row for each range
    inside = ranged.withColumn("_p", F.row_number().over(Window.partitionBy("_r").orderBy(F.desc("similarity"), F.desc("a"), F.desc("b"))))
    return inside.join(F.broadcast(before), "_r").select((F.col("_b") + F.col("_p")).alias("place"), "a", "b", "similarity")


def clusters(groups: DataFrame, counts: DataFrame, text: str = "a", n: str = "n") -> DataFrame:
    """(place, weight, members): groups of ``divergent_groups`` by falling weight, the sum of their members' copies.

    Ties go by the group's least text. The members of a group go by falling copies, then length, then the text.
    """
    member = F.struct(F.negative(n).alias("n"), F.length(text).alias("l"), F.col(text).alias("text"))
    g = groups.join(counts.select(text, n), text).groupBy("group").agg(F.sum(n).alias("weight"), F.array_sort(F.collect_list(member)).alias("_m"))
    place = F.row_number().over(Window.orderBy(F.desc("weight"), "group"))  # groups of a review list, which is read by people
    return g.select(place.cast("long").alias("place"), "weight", F.transform("_m", lambda m: m["text"]).alias("members"))


def review(found: DataFrame, conflicts: DataFrame) -> DataFrame:
    """(section, place, line): the review list of clusters and of bodies stated both with Yes and with No."""
    c = found.select(F.lit("cluster").alias("section"), "place", F.array_join("members", "\n").alias("line"))
    place = F.row_number().over(Window.orderBy("body")).cast("long")
    return c.unionByName(conflicts.select(F.lit("yes/no").alias("section"), place.alias("place"), F.col("body").alias("line")))

"""Question generation from fact tables, matchups, and balancing of questions for each answer."""

from __future__ import annotations

import re
from functools import reduce
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.text import casual, fill
from grainmill.session import hot_split_join, materialize


def entity_questions(entities: DataFrame, templates: DataFrame, name: str, facts: dict[str, str]) -> DataFrame:
    """(ord, q, a): every entity with every template (kind, ord, ask, say) of a fact it has; a null fact gives nothing.

    The templates are a written list, so they go to every executor; the entities stay where they are.
    """
    value = F.coalesce(*[F.when(F.col("kind") == k, F.col(c).cast("string")) for k, c in facts.items()])
    j = entities.join(F.broadcast(templates), F.lit(True)).withColumn("_v", value).where("_v is not null")
    return j.select("ord", fill("ask", name=name).alias("q"), fill(fill("say", name=name), value="_v").alias("a"))


def variants(pairs: DataFrame) -> DataFrame:
    """(q, a): the pairs and their casual forms, equal ones once."""
    return pairs.select("q", "a").unionByName(pairs.select(casual("q").alias("q"), "a")).distinct()


def matchups(chart: DataFrame, kinds: DataFrame) -> DataFrame:
    """(atk, def, mult): every kind against every kind, 1 where the chart says nothing."""
    a, d = kinds.select(F.col("kind").alias("atk")), kinds.select(F.col("kind").alias("def"))
    return a.join(F.broadcast(d), F.lit(True)).join(chart, ["atk", "def"], "left").select("atk", "def", F.coalesce("mult", F.lit(1.0)).alias("mult"))


def multiplier(kind: Column, immune: Column, weak: Column, resist: Column) -> Column:
    """0 for a kind the defender is immune to, else 2 for one it is weak to, else 0.5 for one it resists, else 1."""
    return F.when(F.array_contains(immune, kind), 0.0).when(F.array_contains(weak, kind), 2.0).when(F.array_contains(resist, kind), 0.5).otherwise(1.0)


def chain_sentences(names: DataFrame, edges: DataFrame) -> DataFrame:
    """(name, answer): what each name evolves into and how, for edges (src, dst, method, detail); children in order of name."""
    how = F.when(F.col("method") == "level", F.concat("dst", F.lit(" at level "), "detail")).when(F.col("method") == "stone", F.concat("dst", F.lit(" with a "), "detail")).otherwise(F.concat("dst", F.lit(" when traded")))
    parts = edges.groupBy(F.col("src").alias("name")).agg(F.array_sort(F.collect_list(F.struct("dst", how.alias("how")))).alias("_p"))
    j = names.join(parts, "name", "left")
    said = F.concat("name", F.lit(" evolves into "), F.array_join(F.transform("_p", lambda x: x["how"]), ", "), F.lit("."))
    return j.select("name", F.when(F.col("_p").isNull(), F.concat("name", F.lit(" does not evolve."))).otherwise(said).alias("answer"))


def relationship_questions(edges: DataFrame) -> DataFrame:
    """(q, a): three questions for every edge (src, dst, method, detail): forwards, backwards, and how."""
    s, d, x = F.col("src"), F.col("dst"), F.col("detail")
    c = lambda *p: F.concat(*[F.lit(y) if isinstance(y, str) else y for y in p])
    how = F.when(F.col("method") == "level", c("Level ", s, " up to level ", x, ".")).when(F.col("method") == "stone", c("Use a ", x, " on ", s, ".")).otherwise(c("Trade ", s, "."))
    pairs = F.array(
        F.struct(c("What does ", s, " evolve into?").alias("q"), d.alias("a")),
        F.struct(c("What does ", d, " evolve from?").alias("q"), s.alias("a")),
        F.struct(c("How does ", s, " become ", d, "?").alias("q"), how.alias("a")),
    )
    return edges.select(F.explode(pairs).alias("p")).select("p.q", "p.a")


def bridged(passages: DataFrame, text: str = "text", topic: str = "topic") -> DataFrame:
    """(kind, q, a, text): each passage twice, as prose and as the answer to a question about its topic."""
    p = passages.where(F.col(text).isNotNull() & F.col(topic).isNotNull())
    rows = F.array(
        F.struct(F.lit("prose").alias("kind"), F.lit(None).cast("string").alias("q"), F.lit(None).cast("string").alias("a"), F.col(text).alias("text")),
        F.struct(F.lit("qa").alias("kind"), F.concat(F.lit("Tell me about "), F.col(topic), F.lit(".")).alias("q"), F.col(text).alias("a"), F.lit(None).cast("string").alias("text")),
    )
    return p.select(F.explode(rows).alias("r")).select("r.*")


#: How a command is asked for; {v} is its verb or a synonym of it, {n} the rest of its name.
COMMAND_FRAMES = ("{v} {n}", "{v} the {n}", "I want to {v} the {n}", "please {v} {n}", "can you {v} the {n}", "go ahead and {v} {n}", "{v} {n} now", "let's {v} the {n}")


def command_questions(commands: DataFrame, synonyms: DataFrame, have: DataFrame, n: int) -> DataFrame:
    """(command, q): up to n new questions for each command (command, verb, noun), synonyms x frames minus those it has.

    ``synonyms`` has rows (verb, ord, synonym), a written list; a verb without any stands for itself. ``have`` has
    rows (command, q); letter case is ignored. Frames go by synonym, then in their order.
    """
    s = synonyms.groupBy("verb").agg(F.array_sort(F.collect_list(F.struct("ord", "synonym"))).alias("_s"))
    c = commands.join(F.broadcast(s), "verb", "left").withColumn("_s", F.coalesce("_s", F.array(F.struct(F.lit(0).alias("ord"), F.col("verb").alias("synonym")))))
    e = c.select("command", "noun", F.posexplode("_s").alias("_i", "_v")).select("command", "noun", "_i", F.col("_v.synonym").alias("v"), F.posexplode(F.array(*[F.lit(x) for x in COMMAND_FRAMES])).alias("_k", "_f"))
    q = e.select("command", "_i", "_k", fill(fill("_f", v="v"), n="noun").alias("q"))
    one = q.groupBy("command", F.lower("q").alias("_l")).agg(F.min(F.struct("_i", "_k", "q")).alias("_b"))
    new = one.join(have.select("command", F.lower(F.trim("q")).alias("_l")).distinct(), ["command", "_l"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("command").orderBy("_b"))  # at most synonyms x frames rows of a command
    return new.withColumn("_r", rank).where(F.col("_r") <= n).select("command", F.col("_b.q").alias("q"))


def defence(entities: DataFrame, full: DataFrame, name: str = "name", kinds: str = "kinds") -> DataFrame:
    """(name, atk, mult, bucket): the product of the multipliers of an entity's kinds; bucket immune, quadruple, double, resist or null."""
    e = entities.select(name, F.explode(kinds).alias("def")).join(full, "def")
    m = e.groupBy(name, "atk").agg(F.product("mult").alias("mult"))
    b = F.when(F.col("mult") == 0, "immune").when(F.col("mult") >= 4, "quadruple").when(F.col("mult") > 1, "double").when(F.col("mult") < 1, "resist")
    return m.withColumn("bucket", b)


def offence(entities: DataFrame, full: DataFrame, name: str = "name", kinds: str = "kinds") -> DataFrame:
    """(name, covered): the kinds that at least one of an entity's kinds hits for more than 1, in order of name."""
    e = entities.select(name, F.explode(kinds).alias("atk")).join(full.where("mult > 1"), "atk")
    return e.groupBy(name).agg(F.array_sort(F.collect_set("def")).alias("covered"))


#: How a question for an answer without enough of them is put.
FRAMES = (
    "What should I know about {t}?",
    "Tell me more about {t}.",
    "Can you explain {t}?",
    "How does {t} work?",
    "Give me details on {t}.",
    "What is there to say about {t}?",
    "I have a question about {t}.",
    "Could you describe {t}?",
)


def diverse(questions: list[str], n: int) -> list[str]:
    """n of the questions by greedy diversity.

    Up to n, all. Otherwise the shortest and the longest first, then again and again the question with the greatest
    10 x (words not yet covered) + |length - mean length of the chosen|; ties go to the earliest.
    """
    if len(questions) <= n:
        return list(questions)
    words = [frozenset(re.findall(r"\w+", q.lower())) for q in questions]
    rest = list(range(len(questions)))
    chosen: list[int] = []
    seen: set[str] = set()
    for pick in (min, max):
        if len(chosen) < n:
            k = pick(rest, key=lambda i: len(questions[i]))
            chosen.append(k)
            rest.remove(k)
            seen |= words[k]
    while len(chosen) < n:
        mean = sum(len(questions[i]) for i in chosen) / len(chosen)
        k = max(rest, key=lambda i: (10 * len(words[i] - seen) + abs(len(questions[i]) - mean), -i))
        chosen.append(k)
        rest.remove(k)
        seen |= words[k]
    return [questions[i] for i in chosen]


def paraphrases(answer: str, have: list[str], n: int) -> list[str]:
    """n new questions for the answer, by frames over its longest word; numbered once the frames run out."""
    words = re.findall(r"\w+", answer)
    subject = max(words, key=len) if words else "this"
    known = {q.lower().rstrip("?. ") for q in have}
    out: list[str] = []
    k = 0
    while len(out) < n:
        frame = FRAMES[k % len(FRAMES)]
        q = frame.format(t=subject) if k < len(FRAMES) else f"{frame.format(t=subject)[:-1]} ({k // len(FRAMES) + 1})" + frame[-1]
        k += 1
        if q.lower().rstrip("?. ") not in known:
            known.add(q.lower().rstrip("?. "))
            out.append(q)
    return out


#: Answers with more different questions than this are chosen from by all tasks together.
WEIGHED = 2_000


def balance(pairs: DataFrame, target: int = 5, key: tuple[str, ...] = ("prefix", "a"), q: str = "q", order: str = "pair_id") -> DataFrame:
    """(key, q, made): exactly ``target`` questions for every answer.

    More than that: different questions, the most diverse kept, filled up if there are fewer. Fewer: all kept, the
    missing ones made. Exactly as many: unchanged, repeats included. Null answers are left out, null questions count
    as empty. An answer with very many questions first loses repeats by a shuffle; above WEIGHED each step of the
    choice is one aggregation over all its questions, with the same result.
    """
    x = pairs.where(F.col("a").isNotNull()).select(*key, F.coalesce(q, F.lit("")).alias("q"), F.col(order).alias("o"))
    # one text for each key, in which null differs from every value
    x = x.withColumn("_k", F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in key]))
    n = materialize(x.groupBy("_k").agg(F.count("*").alias("n")).withColumn("rows", F.col("n")), "sizes")
    marked = hot_split_join(x, n, "_k", "rows", keep_key=False)
    exact = marked.where(F.col("n") == target).select(*key, "q", F.lit(False).alias("made"))
    few = marked.where(F.col("n") < target).groupBy(*key, "q").agg(F.min("o").alias("o"), F.count("*").alias("k"))
    many = marked.where(F.col("n") > target).groupBy(*key, "q").agg(F.min("o").alias("o"), F.lit(1).cast("long").alias("k"))
    many = _choose_crowded(materialize(many, "many"), list(key), target)
    schema = many.select(*key, "q").schema.simpleString()[7:-1].replace(":", " ")

    answer = key.index("a")

    def finish(batches):
        for b in batches_of(finished(batches), 5_000):
            yield pd.DataFrame(b, columns=[*key, "q", "made"])

    def finished(batches):
        for k, rows in _groups(batches, list(key), ["q", "k"]):
            have = diverse([q for q, n in rows for _ in range(n)], target)
            made = paraphrases(k[answer], have, target - len(have))
            yield from ((*k, q, False) for q in have)
            yield from ((*k, q, True) for q in made)

    together = few.unionByName(many).repartition(*key).sortWithinPartitions(*key, F.asc_nulls_last("o"), "q")
    return exact.unionByName(together.mapInPandas(finish, schema + ", made boolean"))


def batches_of(rows, n: int):
    """Lists of n rows at most."""
    it = iter(rows)
    while some := list(islice(it, n)):
        yield some


def _groups(batches, key: list[str], values: list[str]):
    """(key, rows of values) of the runs of equal keys of sorted batches."""
    last, held = None, []
    for b in batches:
        ks = zip(*[b[c].astype(object).where(b[c].notna(), None).tolist() for c in key])
        for k, v in zip(ks, zip(*[b[c].tolist() for c in values])):
            if k != last:
                if held:
                    yield last, held
                last, held = k, []
            held.append(v)
    if held:
        yield last, held


def _choose_crowded(many: DataFrame, key: list[str], target: int) -> DataFrame:
    """The questions that ``diverse`` chooses of answers with more than WEIGHED different ones; other answers unchanged."""
    n = materialize(many.groupBy(*key).agg(F.count("*").alias("crowd")).where(F.col("crowd") > WEIGHED), "crowds")
    if not n.limit(1).count():
        return many

    def on(right: str):
        same = [F.col(f"l.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in key]
        return reduce(lambda x, y: x & y, same)

    def measure(batches):
        for b in batches:
            yield b.assign(words=[sorted(set(re.findall(r"\w+", q.lower()))) for q in b["q"]], size=b["q"].map(len).astype("int64"))

    schema = many.schema.simpleString()[7:-1].replace(":", " ") + ", words array<string>, size bigint"
    crowded = materialize(many.alias("l").join(n.alias("r"), on("r"), "left_semi").mapInPandas(measure, schema), "crowded")
    state = n.select(*key, F.array().cast("array<string>").alias("chosen"), F.array().cast("array<string>").alias("seen"), F.lit(0).cast("long").alias("total"))
    for step in range(target):
        rest = crowded.alias("l").join(state.alias("s"), on("s")).where(~F.array_contains("s.chosen", F.col("l.q")))
        new = 10 * F.size(F.array_except("l.words", "s.seen")) + F.abs(F.col("l.size") - F.col("s.total") / F.lit(max(step, 1)))
        rank = F.col("l.size").cast("double") if step == 0 else F.negative(F.col("l.size").cast("double")) if step == 1 else F.negative(new)
        first = F.min(F.struct(rank.alias("rank"), F.col("l.o").isNull().alias("last"), F.col("l.o").alias("o"), F.col("l.q").alias("q"), F.col("l.words").alias("words"), F.col("l.size").alias("size")))
        best = rest.groupBy(*[F.col(f"l.{k}").alias(k) for k in key]).agg(first.alias("b"))
        state = materialize(
            best.alias("l").join(state.alias("s"), on("s")).select(
                *[F.col(f"l.{k}") for k in key], F.concat("s.chosen", F.array("b.q")).alias("chosen"), F.array_union("s.seen", F.col("b.words")).alias("seen"), (F.col("s.total") + F.col("b.size")).alias("total")
            ),
            "state",
        )
    kept = crowded.alias("l").join(state.alias("s"), on("s")).where(F.array_contains("s.chosen", F.col("l.q"))).select(*[F.col(f"l.{c}") for c in many.columns])
    return materialize(many.alias("l").join(n.alias("r"), on("r"), "left_anti").unionByName(kept), "many")


def choose(rows: DataFrame, conflict_key: str, order: str) -> DataFrame:
    """The first row of every key in order."""
    cols = [c for c in rows.columns if c != conflict_key]
    return rows.groupBy(conflict_key).agg(F.min_by(F.struct(*cols), order).alias("w")).select(conflict_key, "w.*")


def split_of(key: Column, eval_per_mille: int, seed: int = 42) -> Column:
    """eval or train by a hash of the key: the same on every run and engine size."""
    return F.when(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1000)) < eval_per_mille, "eval").otherwise("train")

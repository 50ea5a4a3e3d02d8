import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainmill import sinks
from grainmill.functions import text as tx
from grainmill.operators import generate, graph, ordered, packing, profile, quality, rules, similarity, vocab
from grainmill.session import hot_split_join, materialize


def one(spark, value, f, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(("items", "said"), [([], ""), (["a"], "a"), (["a", "b"], "a and b"), (["a", "b", "c"], "a, b, and c")])
def test_list_join(spark, items, said):
    assert one(spark, items, tx.list_join, "x array<string>") == said


def test_text_functions(spark):
    assert one(spark, "", tx.tokens) == []
    assert one(spark, " a\tb ", tx.tokens) == ["a", "b"]
    assert one(spark, "Élan vital", tx.unicode_words) == ["élan", "vital"]
    assert one(spark, "a b", lambda x: tx.ngrams(tx.tokens(x), 3)) == []
    assert one(spark, "a b c d", lambda x: tx.ngrams(tx.tokens(x), 3)) == ["a b c", "b c d"]
    assert one(spark, "Hello, World!", tx.slug) == "hello-world"
    assert one(spark, "hELLO", tx.capitalize) == "Hello"
    assert one(spark, "What now? ", tx.casual) == "what now"
    assert one(spark, "Yes. It does.", tx.lead_of) == "Yes"
    assert one(spark, "Yes. It does.", tx.body_of) == "It does."
    assert one(spark, "Run  x", tx.verb_key) == "x"
    assert one(spark, "aXbxc", lambda x: tx.snippet(x, F.lit("x"), 1)) == "aXb"
    assert one(spark, "aaaa", lambda x: tx.occurrences(x, F.lit("aa"))) == 2
    assert one(spark, "ĠaĊ", tx.unescape_token) == " a\n"
    assert one(spark, list("abcdefgh"), lambda x: tx.capped_list(x, 3), "x array<string>") == "a, b, c, among others"
    assert spark.range(1).select(tx.overlap(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b")))).first()[0] == 1.0
    assert spark.range(1).select(tx.overlap(F.array(F.lit("a")), F.array().cast("array<string>"))).first()[0] == 0.0


def test_frequency_summary(spark):
    df = spark.createDataFrame([(c,) for c in "abccdddd"] + [(None,), (" ",)], "a string")
    f = profile.frequency(df, "a")
    assert tuple(profile.frequency_summary(f).first()) == (8, 4, 4, 1, 1)
    assert {tuple(x) for x in profile.histogram(f).collect()} == {(1, 2), (2, 1), (4, 1)}
    assert tuple(profile.frequency_summary(f.where("n > 9")).first()) == (0, 0, None, None, None)


def union_find(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(up)}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(200, 240)] + [(5, 5), (900, 900), (None, 3), (300, 299), (300, 299)]
    got = {x.node: x.component for x in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == union_find(edges)
    assert graph.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_star_of_high_degree(spark):
    star = spark.range(1, 3000).selectExpr("0L as src", "id as dst")
    assert graph.connected_components(star).groupBy("component").count().collect()[0]["count"] == 3000


def test_resolve_map_chains_and_cycle(spark):
    m = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "z"), ("z", "y"), (None, "q")], "src string, dst string")
    assert {x.src: x.dst for x in graph.resolve_map(m).collect()} == {"a": "c", "b": "c", "x": "y", "z": "y"}


def test_walks_with_branch_cycle_and_loner(spark):
    n = spark.createDataFrame([(x,) for x in "abcdeuv"], "name string")
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("b", "d"), ("u", "v"), ("v", "u")], "src string, dst string")
    assert {(x.base, x.final, x.path) for x in graph.chains(n, e).collect()} == {("a", "c", "a > b > c"), ("a", "d", "a > b > d"), ("e", "e", "e")}


def test_walks_have_no_greatest_depth(spark):
    e = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(53)], "src string, dst string").coalesce(1)
    n = spark.createDataFrame([("n0",)], "name string")
    assert [(x.base, x.final) for x in graph.chains(n, e).collect()] == [("n0", "n53")]


def test_running_sum_and_neighbours_across_chunks(spark):
    r = random.Random(4)
    rows = [(k, i, r.randrange(3)) for k in "ab" for i in sorted(r.sample(range(500), 90))]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    s = {(x.k, x.i): x.s for x in ordered.running_sum(df, "k", "i", F.col("v"), "s", 20).collect()}
    n = {(x.k, x.i): (x.prev_v, x.next_v) for x in ordered.neighbours(df, "k", "i", ["v"], 20).collect()}
    for k in "ab":
        mine = [(i, v) for kk, i, v in rows if kk == k]
        for j, (i, _) in enumerate(mine):
            assert s[k, i] == sum(v for _, v in mine[: j + 1])
            assert n[k, i] == (mine[j - 1][1] if j else None, mine[j + 1][1] if j + 1 < len(mine) else None)


def test_sessions_drop_lines_before_the_first_marker(spark):
    rows = [("p", 1, "noise"), ("p", 2, 'llm ask "x"'), ("p", 3, None), ("p", 4, 'llm generate "y"'), ("p", 5, 'llm ask "z"')]
    got = [(x.line_no, x.session) for x in ordered.sessions(spark.createDataFrame(rows, "path string, line_no int, line string")).orderBy("line_no").collect()]
    assert got == [(2, 1), (3, 1), (4, 2), (5, 3)]


def test_topics_with_regex_miss_and_null(spark):
    r = spark.createDataFrame([("t", ["if.*then", "lamp"]), ("none", ["zzz"]), ("empty", [])], "topic string, keywords array<string>")
    t = spark.createDataFrame([(1, "IF so THEN no"), (2, "a Lamp"), (3, "x"), (4, None)], "id int, t string")
    assert {tuple(x) for x in rules.topics(t, ["id"], F.col("t"), r).collect()} == {(1, "t"), (2, "t")}


def test_rules_in_blocks_equal_one_block(spark, monkeypatch):
    r = spark.createDataFrame([(f"w{i}",) for i in range(12)], "w string")
    t = spark.createDataFrame([(i, f"x w{i} w{i + 1} y") for i in range(12)], "id int, t string")
    cond = rules.contains("t", "w")
    whole = {tuple(x) for x in rules.match(t, r, cond).select("id", "w").collect()}
    monkeypatch.setattr(rules, "RULES_PER_BLOCK", 5)
    assert {tuple(x) for x in rules.match(t, r, cond).select("id", "w").collect()} == whole


def test_first_prefix_takes_list_order(spark):
    r = spark.createDataFrame([(1, "Can you "), (0, "can "), (2, "x")], "ord int, prefix string")
    t = spark.createDataFrame([(1, "CAN you go"), (2, "no")], "id int, q string")
    assert [tuple(x) for x in rules.first_prefix(t, ["id"], "q", r).collect()] == [(1, "CAN you go", "can ")]


def test_whole_word_or_anywhere(spark):
    r = spark.createDataFrame([("ab", True), ("a.b", True), ("cd", False)], "term string, word boolean")
    t = spark.createDataFrame([("xab",), ("x ab.",), ("axb",), ("a.b!",), ("xcdx",)], "t string")
    assert {tuple(x) for x in rules.match(t, r, rules.term_or_word("t", "term", "word")).select("t", "term").collect()} == {("x ab.", "ab"), ("a.b!", "a.b"), ("xcdx", "cd")}


def test_near_pairs_equal_brute_force(spark):
    r = random.Random(6)
    words = [f"w{i}" for i in range(30)] + ["the"] * 15
    ts = sorted({" ".join(r.choice(words) for _ in range(r.randrange(1, 9))) for _ in range(150)}) + [None, "", "The w1 w2 w3 w4"]
    got = {(x.a, x.b, x.shared, x.smaller) for x in similarity.near_pairs(spark.createDataFrame([(t,) for t in ts], "a string")).collect()}
    sets = {t: set(t.lower().split()) for t in ts if t}
    want = set()
    for a in sets:
        for b in sets:
            k, m = len(sets[a] & sets[b]), min(len(sets[a]), len(sets[b]))
            if a < b and 4 * k >= 3 * m:
                want.add((a, b, k, m))
    assert got == want and want


def test_canonical_merge_rules(spark):
    c = spark.createDataFrame(
        [("Run x", 1, 1), ("Run y", 5, 2), ("Use y", 1, 3), ("Type z", 1, 4), ("Run z", 9, 5), ("a  b", 1, 6), ("a b", 1, 7)], "a string, n long, first long"
    )
    assert {tuple(x) for x in similarity.canonical_merge(c).collect()} == {("Run y", "Type y"), ("Use y", "Type y"), ("Run z", "Type z"), ("a  b", "a b")}


def test_core_of_follows_chains(spark):
    base = "One two three."
    c = spark.createDataFrame([(base,), (base + " More.",), (base + " More. Most.",), ("Short one.",), ("Short one. X.",), ("Yes. " + base,)], "a string")
    assert {tuple(x) for x in similarity.core_of(c).collect()} == {(base + " More.", base), (base + " More. Most.", base)}


def test_polarity_and_map(spark):
    c = spark.createDataFrame([("Yes. b",), ("No. b",), ("Yes. c",), (None,)], "a string")
    assert [tuple(x) for x in similarity.polarity_conflicts(c).collect()] == [("b", 1, 1)]
    m = spark.createDataFrame([("Yes. c", "d")], "a string, to string")
    assert {tuple(x) for x in similarity.apply_map(c, m, "a", "to").collect()} == {("Yes. b", False), ("No. b", False), ("d", True), (None, False)}


def test_balance_gives_five_each(spark, monkeypatch):
    rows = [(i, "A", "a1", f"question number {i} of {i * i}") for i in range(40)] + [(100, None, "a2", "x"), (101, None, "a2", "x"), (102, "Do", "a3", None)]
    rows += [(200 + i, "A", "a5", "same") for i in range(5)] + [(300 + i, "A", "a7", "same") for i in range(7)] + [(400, "A", None, "q")]
    df = spark.createDataFrame(rows, "pair_id long, prefix string, a string, q string")
    monkeypatch.setattr(generate, "WEIGHED", 10)
    got = generate.balance(df).collect()
    n = Counter((x.prefix, x.a) for x in got)
    assert n == {("A", "a1"): 5, (None, "a2"): 5, ("Do", "a3"): 5, ("A", "a5"): 5, ("A", "a7"): 5}
    assert sum(x.made for x in got if x.a == "a7") == 4 and not any(x.made for x in got if x.a in ("a1", "a5"))
    monkeypatch.setattr(generate, "WEIGHED", 2000)
    qs = [r[3] for r in rows if r[2] == "a1"]
    assert {x.q for x in generate.balance(df).where("a = 'a1'").collect()} == set(generate.diverse(qs, 5))


def test_crowded_answers_get_the_same_questions(spark, monkeypatch):
    monkeypatch.setattr(generate, "WEIGHED", 10)
    r = random.Random(4)
    qs = [" ".join(r.choice("How can one Open close LID pump ärger 12 water? of the".split()) for _ in range(r.randrange(2, 12))) for _ in range(90)]
    rows = [(None if i % 2 else "p", f"a{i % 3}", q, i) for i, q in enumerate(qs)]
    got = Counter((x.prefix, x.a, x.q) for x in generate.balance(spark.createDataFrame(rows, "prefix string, a string, q string, pair_id long")).collect())
    keys = {(p, a) for p, a, *_ in rows}
    assert got == Counter((*k, q) for k in keys for q in generate.diverse(list(dict.fromkeys(q for p, a, q, _ in rows if (p, a) == k)), 5))


def test_diverse_selection():
    assert generate.diverse(["b", "a"], 5) == ["b", "a"]
    assert generate.diverse(["aa bb", "a", "cc dd ee ff", "aa", "zz yy"], 3) == ["a", "cc dd ee ff", "aa bb"]


def test_label_mask_and_packing(spark):
    q, lq, marks = [81, 58], [10, 81, 58], [[10, 65, 58]]
    enc = lambda s: [ord(c) for c in s]
    texts = ["prose only", "Q: a\nA: b", "Q: a\nA: b\nQ: c\nA: d e", "x\nA:", ""]
    df = spark.createDataFrame([(i, enc(t)) for i, t in enumerate(texts)] + [(9, None)], "id int, ids array<int>")
    got = {x.id: x.labels for x in packing.label_mask(df, "ids", marks, q, lq).collect()}

    def plain(ids):
        t = "".join(map(chr, ids))
        if "\nA:" not in t:
            return ids
        on, out, i = False, [], 0
        starts = {i + 3 for i in range(len(t)) if t.startswith("\nA:", i)}
        stops = {i for i in range(len(t)) if t.startswith("\nQ:", i)} | ({0} if t.startswith("Q:") else set())
        for i, x in enumerate(ids):
            on = True if i in starts else (False if i in stops else on)
            out.append(x if on else -100)
        return out

    for i, t in enumerate(texts):
        assert list(got[i]) == plain(enc(t))
    assert got[9] is None
    packed = packing.pack_entries(packing.label_mask(df.where("id < 9"), "ids", marks, q, lq), "ids", "labels", 12, 0).collect()
    assert len(packed) == 4 and all(len(x.input_ids) == len(x.labels) == 12 for x in packed)
    short = next(x for x in packed if x.id == 1)
    assert short.labels[9:] == [0, -100, -100]


def test_chunks_drop_the_rest(spark):
    df = spark.createDataFrame([(0, 1, [1, 2, 3]), (0, 2, [4, 5]), (1, 3, [6]), (1, 4, None)], "g int, o int, ids array<int>")
    assert [tuple(x) for x in packing.chunk(df, "g", "o", "ids", 2).orderBy("block_no").collect()] == [(0, 0, [1, 2]), (0, 1, [3, 4])]


def test_matchups_and_questions(spark):
    chart = spark.createDataFrame([("a", "b", 2.0), ("a", "c", 2.0), ("b", "a", 0.0)], "atk string, def string, mult double")
    full = generate.matchups(chart, spark.createDataFrame([("a",), ("b",), ("c",)], "kind string"))
    assert full.count() == 9
    e = spark.createDataFrame([("x", ["b", "c"]), ("y", ["a"])], "name string, kinds array<string>")
    d = {(x.name, x.atk): (x.mult, x.bucket) for x in generate.defence(e, full).collect()}
    assert d["x", "a"] == (4.0, "quadruple") and d["y", "b"] == (0.0, "immune") and d["y", "c"] == (1.0, None)
    assert {x.name: x.covered for x in generate.offence(e, full).collect()} == {"y": ["b", "c"]}
    t = spark.createDataFrame([("f", 1, "What of {name}?", "{name}: {value}")], "kind string, ord int, ask string, say string")
    ents = spark.createDataFrame([("p", 3), ("q", None)], "name string, n int")
    assert [tuple(x) for x in generate.entity_questions(ents, t, "name", {"f": "n"}).collect()] == [(1, "What of p?", "p: 3")]


def test_split_is_stable(spark):
    d = spark.range(5000).select("id", generate.split_of(F.col("id"), 100).alias("part"))
    n = d.where("part = 'eval'").count()
    assert 400 < n < 600 and n == d.repartition(7).where("part = 'eval'").count()


def test_domain_vocabulary(spark):
    c = vocab.word_counts(spark.createDataFrame([("lamp lamp the the 123 123 ox ox once",), (None,)], "text string"))
    w = lambda *x: spark.createDataFrame([(y,) for y in x], "word string")
    assert [tuple(x) for x in vocab.domain_vocabulary(c, w("the"), w("once", "never", "ab")).collect()] == [("lamp", 2), ("never", 1), ("once", 1)]


def test_token_coverage_agrees_with_the_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    terms = ["The", "Zorblax", "Paris", "Kraifle", None]
    got = {x.term for x in vocab.fragmented(spark.createDataFrame([(x,) for x in terms], "term string"), "/opt/tokenizers/byte_bpe_50k.tiktoken").collect()}
    assert got == {x for x in terms if x and len(t.encode(x).ids) != 1 and len(t.encode(" " + x).ids) != 1}


def test_quality_flags(spark):
    b = spark.createDataFrame(
        [(1, "qa", "what is a", "short", None, None), (2, "qa", "one", "x" * 500, None, None), (3, "do", "go now please", None, "Type a b c d", None), (4, "prose", None, None, None, "few words"), (5, "orphan_q", "why so", None, None, None), (6, "qa", "why is it", None, None, None)],
        "block_id int, type string, q string, a string, do string, text string",
    )
    got = defaultdict(set)
    for x in quality.issues(b).collect():
        got[x.block_id].add(x.issue)
    assert got[1] == {"short_answer", "question_weak_ending"} and got[2] == {"long_answer", "over_budget", "question_too_short"}
    assert got[3] == {"odd_command"} and got[4] == {"short_prose"} and got[5] == {"orphan_q"} and got[6] == {"blank_response"}
    counts = quality.issues(b).groupBy("issue").agg(F.count("*").alias("n"))
    assert {(x.check, x.n_issues, x.passed) for x in quality.gates(counts, ["orphan_q", "long_prose"]).collect()} == {("orphan_q", 1, False), ("long_prose", 0, True)}


def test_hot_split_join_equals_plain_join(spark):
    r = random.Random(8)
    rows = [(i, "hot" if i % 3 == 0 else f"k{r.randrange(40)}") for i in range(2000)] + [(9999, None), (9998, "missing")]
    df = spark.createDataFrame(rows, "i int, k string")
    look = materialize(df.where("k is not null and k <> 'missing'").groupBy("k").agg(F.count("*").alias("n"), F.first(F.length("k")).alias("v")), "t")
    assert {tuple(x) for x in hot_split_join(df, look, "k", "n").collect()} == {(i, k, len(k)) for i, k in rows if k and k != "missing"}
    assert hot_split_join(df, look, "k", "n", "left").where("v is null").count() == 2
    assert {tuple(x) for x in hot_split_join(df, look, "k", "n", "left", keep_key=False).collect()} == {(i, len(k) if k and k != "missing" else None) for i, k in rows}
    # each part of a hot key has about 1/2000 of the rows: a number of the key's tasks, not one
    many = spark.range(40_000).selectExpr("id", "if(id % 2 = 0, 'hot', string(id)) as k")
    counts = materialize(many.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.length("k")), "look")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = hot_split_join(many, counts, "k", "n").withColumn("task", F.spark_partition_id())
        assert got.count() == 40_000 and got.where("k = 'hot'").select("task").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sinks(spark, tmp_path):
    b = spark.createDataFrame([(1, "q", "a", None, None), (2, None, None, None, "prose"), (3, None, None, None, None)], "id int, q string, a string, do string, text string")
    sinks.write_corpus(b, str(tmp_path / "c"), "id", seed=None)
    text = "".join(p.read_text() for p in sorted((tmp_path / "c").glob("part*")))
    assert text == "Q: q\nA: a\n\nprose\n\n"
    sinks.write_word_list(spark.createDataFrame([("b",), ("a",)], "word string"), str(tmp_path / "w"), ["two words"])
    assert "".join(p.read_text() for p in sorted((tmp_path / "w").glob("part*"))) == "# two words\na\nb\n"
    sinks.write_token_list(spark.createDataFrame([(2, "x"), (1, "y"), (3, "x")], "ord int, token string"), str(tmp_path / "t"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part*"))) == "y\nx\n"
    s = spark.createDataFrame([("s1", 2, "b"), ("s1", 1, "a"), ("s2", 1, "c")], "slug string, line_no int, line string")
    sinks.write_sessions(s, str(tmp_path / "s"))
    assert "".join(p.read_text() for p in (tmp_path / "s" / "slug=s1").glob("part*")) == "a\nb\n"
    ls = spark.createDataFrame([("p", 1, "Q: x"), ("p", 2, "A: old"), ("p", 3, "old")], "path string, line_no int, line string")
    sinks.rewrite_lines(ls, spark.createDataFrame([("old", "new")], "a string, to string"), str(tmp_path / "r"))
    assert "".join(p.read_text() for p in (tmp_path / "r" / "path=p").glob("part*")) == "Q: x\nA: new\nold\n"


def test_changelog_and_tokenizer_block(spark):
    m = spark.createDataFrame([("a", "b"), ("x", "y")], "a string, to string")
    t = spark.createDataFrame([("b", "c"), ("q", "r")], "a string, to string")
    assert {tuple(x) for x in sinks.changelog(m, t).collect()} == {("merged and trimmed", "a", "c"), ("merged", "x", "y"), ("trimmed", "q", "r"), ("trimmed", "b", "c")}
    v = spark.createDataFrame([("a", 0), ("bc", 2)], "token string, id int")
    g = spark.createDataFrame([(0, 0, 0, 2)], "ord int, left_id int, right_id int, new_id int")
    assert sinks.tokenizer_block(v, g) == b"\x03\0\0\0\x01\0\0\0\x01a\0\x02bc" + bytes([0, 0, 0, 0] * 2 + [2, 0, 0, 0])
    assert sinks.tokenizer_stats(v, g).iloc[0]["longest"] == 2


def test_tree_edges_and_numeric_stats(spark):
    t = '{"n": "r", "c": [{"n": "a", "c": [{"n": "b"}]}]}'
    assert {tuple(x) for x in graph.tree_edges(spark.createDataFrame([(t,)], "t string"), "t", "n", "c", 3).collect()} == {("r", "a"), ("a", "b")}
    df = spark.createDataFrame([("z", [0.0] * 20), ("k", [1.0, 2.0]), ("nan", [float("nan"), 1.0])], "g string, v array<double>")
    got = {x.g: x.degenerate for x in profile.numeric_stats(df, "g", "v").collect()}
    assert got == {"z": True, "k": False, "nan": True}
    assert np.isclose(profile.numeric_stats(df, "g", "v").where("g = 'k'").first()["std"], 0.7071067811865476)


def test_ranked_pairs_clusters_and_review(spark):
    rows = [("a b c d", 3), ("a b c d e", 1), ("a b c x", 2), ("q r s t u v w", 9), ("q r s t u v z", 1), ("lonely", 1)]
    t = spark.createDataFrame(rows, "a string, n long")
    p = similarity.near_pairs(t)
    ranked = similarity.ranked_pairs(p).orderBy("place").collect()
    assert [x.place for x in ranked] == list(range(1, len(ranked) + 1))
    assert [(x.similarity, x.a, x.b) for x in ranked] == sorted(((x.similarity, x.a, x.b) for x in ranked), reverse=True)
    g = similarity.divergent_groups(t, parts=4, whole=3)
    c = similarity.clusters(g, t).orderBy("place").collect()
    assert [(x.place, x.weight) for x in c] == [(1, 10), (2, 6)]
    assert c[0].members == ["q r s t u v w", "q r s t u v z"] and c[1].members == ["a b c d", "a b c x", "a b c d e"]
    said = spark.createDataFrame([("b1", 1, 1)], "body string, yes long, no long")
    r = similarity.review(similarity.clusters(g, t), said)
    assert {(x.section, x.place) for x in r.collect()} == {("cluster", 1), ("cluster", 2), ("yes/no", 1)}
    assert similarity.near_pairs(t.where("false")).count() == 0


def test_short_texts_have_near_repeats(spark):
    t = spark.createDataFrame([("yes",), ("Yes yes",), ("yes it does",), ("no",), (None,), (" ",)], "a string")
    assert {(x.a, x.b) for x in similarity.near_pairs(t).collect()} == {("Yes yes", "yes"), ("Yes yes", "yes it does"), ("yes", "yes it does")}


def test_apply_map_with_a_hot_value(spark):
    df = spark.range(6000).selectExpr("if(id % 3 = 0, 'hot', string(id)) as a", "id")
    m = spark.createDataFrame([("hot", "cold"), ("1", "one"), ("nowhere", "x")], "a string, to string")
    got = similarity.apply_map(df, m, "a", "to")
    assert got.where("a = 'cold' and changed").count() == 2000 and got.where("a = 'one'").count() == 1 and got.where("not changed").count() == 3999


def test_sentence_functions(spark):
    t = spark.createDataFrame([("Pump is wet.", 1, "octopus"), ("x" * 61, 11, "bus"), (None, 102, None), ("", 0, "")], "a string, n int, w string")
    got = t.select(tx.shortened("a"), tx.ordinal("n"), tx.with_article("w"), tx.plural("w")).collect()
    assert [tuple(x) for x in got] == [("Pump is wet.", "first", "an octopus", "octopuses"), ("x" * 60 + "...", "11th", "a bus", "buses"), (None, "102nd", None, None), ("", None, "a ", "s")]
    a = spark.createDataFrame([("The Pump sensor is wet.",), ("Type openlid to open the lid, or not.",), ("See ABC-12 there.",), ("Over the other wall and the valve.",), ("",), (None,)], "a string")
    got = [tuple(x) for x in a.select(tx.topic_of("a"), tx.action_of("a")).collect()]
    assert got == [("Pump sensor", "pump sensor"), ("openlid", "open the lid"), ("ABC-12", "abc-12"), ("valve", "valve"), (None, None), (None, None)]
    c = spark.createDataFrame([("Type openlid. then type THE and type x;",)], "a string")
    assert c.select(tx.typed_commands("a")).first()[0] == ["openlid", "x"]


def test_generated_questions(spark):
    names = spark.createDataFrame([("Wob",), ("Mip",)], "name string")
    e = spark.createDataFrame([("Wob", "Zed", "stone", "tide"), ("Wob", "Ark", "level", "12"), ("Wob", "Tam", "trade", None)], "src string, dst string, method string, detail string")
    got = dict(generate.chain_sentences(names, e).collect())
    assert got == {"Wob": "Wob evolves into Ark at level 12, Tam when traded, Zed with a tide.", "Mip": "Mip does not evolve."}
    assert generate.relationship_questions(e).count() == 9
    d = spark.createDataFrame([("text", "pumps"), (None, "x"), ("y", None)], "text string, topic string")
    assert {x.kind for x in generate.bridged(d).collect()} == {"prose", "qa"} and generate.bridged(d).count() == 2
    c = spark.createDataFrame([("openlid", "open", "lid"), ("zaplid", "zap", "lid")], "command string, verb string, noun string")
    s = spark.createDataFrame([("open", 0, "open"), ("open", 1, "unlock")], "verb string, ord int, synonym string")
    have = spark.createDataFrame([("openlid", "OPEN lid"), (None, None)], "command string, q string")
    q = generate.command_questions(c, s, have, 9).collect()
    own = [x.q for x in q if x.command == "openlid"]
    assert len(own) == 9 and "open lid" not in own and "unlock lid" in own and len([x for x in q if x.command == "zaplid"]) == 8
    k = spark.createDataFrame([("a", ["a"], ["a"], []), ("b", [], ["b"], ["b"]), ("c", [], [], ["c"]), ("d", [], [], [])], "k string, i array<string>, w array<string>, r array<string>")
    assert [x[0] for x in k.select(generate.multiplier(F.col("k"), F.col("i"), F.col("w"), F.col("r"))).collect()] == [0.0, 2.0, 0.5, 1.0]


def test_set_differences(spark):
    l = spark.createDataFrame([("p", "1"), ("p", "2"), ("p", "2"), ("q", "1"), (None, "1")], "k string, v string")
    r = spark.createDataFrame([("p", "2"), ("q", "1"), ("s", "9")], "k string, v string")
    assert {tuple(x) for x in rules.set_differences(l, r, "k", "v").collect()} == {("p", 1, 0, 1, True), ("q", 0, 0, 1, False), ("s", 0, 1, 0, True)}


def test_time_follows_the_length_of_a_text(spark):
    """Twice the words or lines take about twice the time, not four times."""
    import time

    from grainmill.sources.text import line_array

    def took(n, run):
        df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(n)), "\n".join(f"line {i}" for i in range(n)))], "k int, t string, l string")
        best = 9e9
        for _ in range(2):
            began = time.time()
            run(df).write.format("noop").mode("overwrite").save()
            best = min(best, time.time() - began)
        return best

    for run in (lambda d: profile.ngram_frequency(d, "t", 3), lambda d: ordered.line_neighbours(d, "k", line_array("l"))):
        took(1000, run)
        short, long = took(20_000, run), took(80_000, run)
        assert long < 8 * max(short, 0.3)


def test_rewritten_lines_keep_their_order(spark, tmp_path):
    rows = [("hot", i, "A: old" if i % 2 else f"Q: q{i}") for i in range(500)] + [("x", 1, "A: other")]
    sinks.rewrite_lines(spark.createDataFrame(rows, "path string, line_no int, line string"), spark.createDataFrame([("old", "new")], "a string, to string"), str(tmp_path / "o"))
    files = sorted((tmp_path / "o" / "path=hot").glob("part-*"))
    got = [x for f in files for x in f.read_text().splitlines()]
    assert got == ["A: new" if i % 2 else f"Q: q{i}" for i in range(500)]


def test_tokenize_equals_the_public_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    from grainmill.operators.tokenize import tokenize

    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    said = ["The pump's lid.", "", None, " \n x", "<|endoftext|> é 日本", "a " * 500]
    df = spark.createDataFrame(list(enumerate(said)), "i int, a string")
    got = {x.i: x.ids for x in tokenize(df, "a", "/opt/tokenizers/byte_bpe_50k.tiktoken").collect()}
    assert got == {i: None if a is None else t.encode(a, add_special_tokens=False).ids for i, a in enumerate(said)}
    assert max(len(x.ids or []) for x in tokenize(df, "a", "/opt/tokenizers/byte_bpe_50k.tiktoken", longest=7).collect()) == 7


def test_token_candidates(spark):
    w = spark.createDataFrame([("kiln",), ("furnace",), ("Furnace",), ("turbine",), ("nozzle",), ("valve2",), (None,)], "word string")
    t = spark.createDataFrame([("TURBINE",), ("x",)], "token string")
    c = spark.createDataFrame([("nozzle",)], "word string")
    assert [x.word for x in vocab.token_candidates(w, t, c).collect()] == ["furnace"]


def test_written_tables_can_be_dropped(spark):
    import os

    from grainmill import session

    kept = session._WRITTEN[:]
    session._WRITTEN.clear()
    t = materialize(spark.range(5), "gone")
    path = t.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and session.drop_written(spark) == 1 and not os.path.exists(path)
    session._WRITTEN.extend(kept)

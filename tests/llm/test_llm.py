"""Small fixtures for the training-data operators: brute-force versions and the odd cases of each docstring."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainmill.llm import bitmap, canonical, defects, encode, forest, leaks, packing, terms, toxic

WORD = re.compile(r"[^\W_]+")


def clash(df):
    """The same table with extra columns named like the operators' own."""
    for c in ("n", "k", "_id", "_c", "word", "node", "rep", "term", "rec", "t", "id"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("x"))
    return df


# ---- 1 defects ----

BLOCKS = "block_id long, type string, q string, a string, do string, text string"


def found(spark, rows):
    got = defects.defects(clash(spark.createDataFrame(rows, BLOCKS)))
    return {x.block_id: x.defect for x in got.collect()}


def test_defect_kinds(spark):
    q = "What does the old pump do every morning?"
    rows = [
        (1, "qa", q, None, None, None), (2, "qa", q, " 　​", None, None), (3, "qa", q, "A: ", None, None), (4, "do", q, None, "Do:", None),
        (5, "qa", q, q.upper(), None, None), (6, "qa", q, f"You asked: {q}", None, None), (7, "qa", q, f"{q} {q}", None, None),
        (8, "qa", q, f"{q} It lifts water.", None, None),
        (9, "qa", q, "I'm sorry, but I can’t help with that.", None, None), (10, "qa", "Was macht die Pumpe?", "Dazu kann ich leider nichts sagen.", None, None),
        (11, "qa", q, "You cannot open the lid while it runs.", None, None), (12, "qa", q, "The pump refuses a second hose, which is normal.", None, None),
        (13, "qa", q, "Die Pumpe wird nach einer Stunde warm und bleibt dann nicht mehr leise.", None, None), (14, "qa", q, "ポンプは静かに動きます。", None, None),
        (15, "qa", q, 'It lifts "le ressort" every morning', None, None),
        (16, "qa", q, "It lifts the water (from", None, None), (17, "qa", q, "It lifts the water until the", None, None), (18, "do", q, None, "openpump --zone=", None),
        (19, "qa", q, "It lifts the cold wat", None, None), (20, "qa", q, "It lifts the cold water", None, None), (21, "qa", q, "Yes", None, None),
        (22, "do", q, None, 'openpump "Vers', None), (23, "do", q, None, "openpump 4", None), (24, "qa", None, "It lifts water.", None, None),
        (25, "prose", None, None, None, "Cold water and more."), (None, "qa", q, None, None, None), (1, "qa", q, None, None, None),
        (26, "qa", q, "x " * 50_000 + "water.", None, None),
    ]
    want = {1: "empty", 2: "empty", 3: "empty", 4: "empty", 5: "copy", 6: "copy", 7: "copy", 9: "refusal", 10: "refusal", 13: "wrong_language", 14: "wrong_language"}
    want |= {16: "truncated", 17: "truncated", 18: "truncated", 19: "truncated", 22: "truncated"}
    assert found(spark, rows) == want


def sample(r, parsed):
    """A text that a parsed regular expression matches, alternatives and repeats by chance."""
    out = ""
    for op, arg in parsed:
        match str(op):
            case "LITERAL":
                out += chr(arg)
            case "ANY":
                out += "x"
            case "IN":
                out += chr(r.choice([v if str(o) == "LITERAL" else 32 for o, v in arg]))
            case "BRANCH":
                out += sample(r, r.choice(arg[1]))
            case "SUBPATTERN":
                out += sample(r, arg[-1])
            case "MAX_REPEAT":
                out += "".join(sample(r, arg[2]) for _ in range(r.randint(arg[0], min(arg[1], arg[0] + 1))))
    return out


def test_every_refusal_has_a_hint():
    r = random.Random(1)
    rules = [x for group in defects.REFUSALS.values() for x in group]
    ts = sorted({sample(r, re._parser.parse(x)).strip() for x in rules for _ in range(2000)})
    ts = [t for t in ts if defects._REFUSAL.search(t)]
    assert len(ts) > 500
    assert [t for t in ts if not defects.refuses(t, set(WORD.findall(t)))] == []


def test_refusals_of_any_length_and_wording(spark):
    q = "How do I open the lid?"
    said = ["Not able to help with that.", "Can not comply.", "This model does not answer such questions.", "I cannot help with that. " + "The lid is part of the pump. " * 30]
    rows = [(i, "qa", q, a, None, None) for i, a in enumerate(said)]
    assert found(spark, rows) == dict.fromkeys(range(len(said)), "refusal")


def test_all_defects_of_a_pair(spark):
    q = "What does the old pump do every morning?"
    rows = [
        (1, "qa", q, "Dazu kann ich leider nichts sagen, bitte frage jemand, der mit der Pumpe mehr zu tun hat.", None, None), (2, "qa", q, "I'm sorry, but I can't say what the", None, None),
        (3, "qa", "What is (the", "What is (the", None, None), (4, "qa", "Can I say I refuse?", "Can I say I refuse?", None, None), (5, "qa", q, "", None, None),
    ]
    rows.append((6, "qa", q, "Die Pumpe wird of nach einer Stunde warm und bleibt dann nicht mehr leise, weil", None, None))
    got = {x.block_id: (x.defects, x.defect) for x in defects.defects(spark.createDataFrame(rows, BLOCKS)).collect()}
    want = {6: ["wrong_language", "truncated"], 1: ["refusal", "wrong_language"], 2: ["refusal", "truncated"], 3: ["copy", "truncated"], 4: ["copy", "refusal"], 5: ["empty"]}
    assert got == {k: (v, v[0]) for k, v in want.items()}


def test_a_hot_cut_word(spark):
    q = "What does the old pump do every morning?"
    rows = [(i, "qa", q, f"It lifts {i} times the cold wat", None, None) for i in range(3000)] + [(9000, "qa", q, "It lifts water.", None, None)]
    assert found(spark, rows) == dict.fromkeys(range(3000), "truncated")


def test_defects_of_nothing(spark):
    assert found(spark, []) == {}
    assert found(spark, [(1, "prose", None, None, None, None), (2, "orphan_q", "x", None, None, None)]) == {}


# ---- 2 packing ----


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_invariants(seed):
    r = np.random.default_rng(seed)
    for cap in (1, 7, 128):
        n = r.integers(0, cap + 1, 300)
        for way in (packing.best_fit, packing.fullest_first, packing.pack_bins):
            b = way(n, cap)
            fill = np.bincount(b, n)
            assert fill.max() <= cap and (np.sort(fill[fill > 0])[:2].sum() > cap or (fill > 0).sum() < 2)
    assert len(packing.pack_bins(np.empty(0, np.int64), 5)) == 0
    assert packing.pack_bins(np.array([7, 5, 5, 4, 4, 3]), 14).max() == 1


def test_pack_keeps_everything(spark):
    r = random.Random(1)
    rows = [(i, "q" * r.randrange(0, 300), "a" * r.choice([0, 3, 200, 900])) for i in range(600)] + [(7, "q" * 5000, None), (600, None, None), (None, "x", "y")]
    df = clash(spark.createDataFrame(rows, "pair_id long, q string, a string"))
    size = defaultdict(int)
    for i, q, a in rows:
        if i is not None:
            size[i] = max(size[i], -(-(len(q or "") + len(a or "")) // 4))
    blocks = []
    for parts in (10_000, 40):
        got = packing.pack(df, "pair_id", packing.pair_length(), 128, items_per_partition=parts, fan_in=3).collect()
        per, fill = defaultdict(list), Counter()
        for x in got:
            per[x.pair_id].append((x.piece_no, x.piece_len))
            fill[x.block] += x.piece_len
        assert set(per) == set(size) and max(fill.values()) <= 128
        for i, p in per.items():
            assert sum(n for _, n in p) == size[i] and [k for k, _ in sorted(p)] == list(range(len(p))) and all(n == 128 for _, n in sorted(p)[:-1])
        assert len(fill) <= 1.05 * sum(size.values()) / 128 + 2
        blocks.append(len(fill))
    # forty items leave little choice of what goes together; one partition of all is the better by a few in a hundred
    assert blocks[1] <= 1.03 * blocks[0]
    again = packing.pack(df.repartition(3), "pair_id", packing.pair_length(), 128, items_per_partition=40, fan_in=3)
    assert {tuple(x) for x in again.collect()} == {tuple(x) for x in got}
    assert packing.pack(df.where("false"), "pair_id", packing.pair_length(), 128).count() == 0


# ---- 3 near duplicates ----


def brute_groups(rows):
    texts = {}
    for i, a in rows:
        w = WORD.findall((a or "").lower())
        if i is not None and len(w) >= 12:
            texts[i] = Counter(zip(w, w[1:]))
    up = {i: i for i in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if 2 * sum((texts[i] & texts[j]).values()) >= max(sum(texts[i].values()), sum(texts[j].values())):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: root(i) for i in texts}


def edited(r, words, n):
    w = list(words)
    for _ in range(n):
        k = r.randrange(len(w))
        w[k : k + 1] = r.choice([[], [w[k], "extra"], ["other%d" % r.randrange(99)]])
    return " ".join(w)


def test_groups_equal_brute_force(spark):
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(40):
        base = [r.choice(vocab) for _ in range(r.randrange(12, 40))]
        for _ in range(r.randrange(1, 6)):
            rows.append((i, edited(r, base, r.randrange(0, 5))))
            i += 1
    rows += [(i, "Same words, " * 7), (i + 1, "same WORDS " * 7), (i + 2, None), (i + 3, "short text"), (i + 4, ""), (None, "x " * 20), rows[0], (i + 5, "long " * 30_000 + "end"), (i + 6, "long " * 30_000)]
    df = clash(spark.createDataFrame(rows, "answer_id long, a string"))
    got = {x.answer_id: x.group_id for x in forest.near_groups(df).collect()}
    want = brute_groups(rows)
    assert got == want
    pairs = {tuple(x) for x in forest.group_pairs(spark.createDataFrame(list(got.items()), "answer_id long, group_id long")).collect()}
    assert pairs == {(a, b) for a in want for b in want if a < b and want[a] == want[b]}
    assert forest.near_groups(df.where("false")).count() == 0


def test_crowded_region_stays_one_group(spark, monkeypatch):
    monkeypatch.setattr(forest, "CROWDED", 16)
    base = [f"common{i}" for i in range(30)]
    rows = [(i, " ".join([*base[: i % 25], f"v{i}", *base[i % 25 :]])) for i in range(400)]
    got = forest.near_groups(spark.createDataFrame(rows, "answer_id long, a string")).collect()
    assert len(got) == 400 and {x.group_id for x in got} == {0}


def reworked(size):
    """Half of each text is that of all, the other half is shared with one text that has nothing else of it."""
    r = random.Random(3)
    base = [f"common{i}" for i in range(13)]
    rows = []
    for i in range(size):
        own = [f"own{i}x{k}" for k in range(12)]
        rows.append((i, " ".join([*own, *base] if i % 2 else [*base, *own])))
        rows.append((size + i, " ".join([*own[:7], *[f"else{r.randrange(10**9)}" for _ in range(6)]])))
    return rows


def groups_of(spark, rows):
    return {x.answer_id: x.group_id for x in forest.near_groups(spark.createDataFrame(rows, "answer_id long, a string")).collect()}


def test_links_of_a_hot_text_equal_brute_force(spark):
    rows = reworked(150)
    assert groups_of(spark, rows) == brute_groups(rows)


def many_edits(seed=8):
    r = random.Random(seed)
    base = [f"common{i}" for i in range(30)]
    return [(i, edited(r, base, r.randrange(4, 26))) for i in range(250)]


def test_crowded_lists_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(forest, "CROWDED", 16)
    rows = many_edits()
    assert groups_of(spark, rows) == brute_groups(rows)


def test_what_the_forest_leaves_apart_is_found_exactly(spark, monkeypatch):
    rows = many_edits(9) + [(1000 + i, a) for i, a in reworked(60)]
    want = brute_groups(rows)
    monkeypatch.setattr(forest, "forest_pairs", lambda sets, similarity: sets.select(F.col("rep").alias("lo"), F.col("rep").alias("hi")).where("false"))
    for crowded in (20_000, 16):
        monkeypatch.setattr(forest, "CROWDED", crowded)
        assert groups_of(spark, rows) == want


def test_the_forest_alone_finds_nearly_all(spark, monkeypatch):
    r = random.Random(6)
    vocab = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(300):
        base = [r.choice(vocab) for _ in range(r.randrange(20, 60))]
        rows += [(len(rows) + k, edited(r, base, r.randrange(1, 6))) for k in range(3)]
    want = brute_groups(rows)
    monkeypatch.setattr(forest, "left_pairs", lambda sets, similarity: sets.select(F.col("rep").alias("lo"), F.col("rep").alias("hi")).where("false"))
    got = groups_of(spark, rows)
    assert sum(got[i] == want[i] for i in want) > 0.95 * len(want)


def test_possible_refuses_no_link():
    r = random.Random(7)
    texts = [edited(r, [f"c{i}" for i in range(40)], r.randrange(0, 30)) for _ in range(200)]
    h, starts = forest.shingles(texts)
    n, bits = np.diff(np.r_[starts, len(h)]), forest._bitmaps(h, starts)
    sets = [set(x) for x in np.split(h, starts[1:])]
    i, j = np.triu_indices(len(texts), 1)
    links = np.array([len(sets[a] & sets[b]) >= 0.5 * max(n[a], n[b]) for a, b in zip(i, j)])
    possible = forest._possible(i, j, n, bits, 0.5)
    assert links.any() and not (links & ~possible).any() and (~possible).any()


def test_group_pairs_of_a_large_group(spark):
    g = spark.range(2300).selectExpr("id as answer_id", "0L as group_id")
    assert forest.group_pairs(g).count() == 2300 * 2299 // 2


# ---- 4 copies ----


def test_copies_equal_brute_force(spark):
    r = random.Random(2)
    base = ["The pump", "a b", "b a", "", None, "élan vital", "elan vital", "ab", "x" * 20_000]
    dress = [str.upper, lambda s: f"  {s}!!", lambda s: s.replace(" ", "\n\t"), lambda s: s]
    rows = []
    for i in range(300):
        q, a = (r.choice(base) for _ in range(2))
        rows.append((i, *(x if x is None else r.choice(dress)(x) for x in (q, a))))
    rows += [rows[3], (None, "a", "b")]
    df = clash(spark.createDataFrame(rows, "pair_id long, q string, a string"))
    sets = defaultdict(set)
    for i, q, a in rows:
        if i is not None:
            sets[tuple(sorted(" ".join(WORD.findall((x or "").lower())) for x in (q, a)))].add(i)
    want = {(i, min(s), len(s)) for s in sets.values() if len(s) > 1 for i in s}
    assert {(x.pair_id, x.keep_id, x.n_copies) for x in canonical.copies(df).collect()} == want
    assert {tuple(x) for x in canonical.collapsed(df).collect()} == {(min(s), len(s)) for s in sets.values()}
    assert canonical.copies(df.where("false")).count() == 0 and canonical.collapsed(df.where("false")).count() == 0


# ---- 5 terms ----


def test_terms_equal_brute_force(spark):
    r = random.Random(3)
    voc = ["Hot", "hot", "été", "x1", "日本", "rare%d"]
    rows = [(i, " ".join((w % i if "%" in (w := r.choice(voc)) else w) for _ in range(r.randrange(0, 9))), r.choice([None, "", "hot, hot;hot", "a" * 30_000])) for i in range(400)]
    rows += rows[:20] + [(None, "ghost", "ghost")]
    occ, rec = Counter(), Counter()
    for i, q, a in {x for x in rows if x[0] is not None}:
        w = WORD.findall(q.lower()) + WORD.findall((a or "").lower())
        occ.update(w)
        rec.update(set(w))
    want = {(t, occ[t], rec[t], "rare" if rec[t] <= 2 else "common" if rec[t] * 20 > 400 else None) for t in occ}
    df = clash(spark.createDataFrame(rows, "block_id long, q string, a string")).repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        got = {tuple(x) for x in terms.marked_terms(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want
    assert terms.marked_terms(df.where("false")).count() == 0


def test_ranges_follow_the_size():
    assert terms.n_ranges(0) == 1 and terms.n_ranges(80 << 20) == 10
    assert terms.n_ranges(1 << 40) == 4096 and terms.n_ranges(1 << 44) == 1 << 16


# ---- 6 encoding ----


def test_ids_equal_the_public_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = ["", None, "   ", " \n\n x", "It's <|endoftext|> we'll", "日本語 👩‍🔧 ​　é", "tab\t\tx\r\n", "a" * 40_000, "the " * 20_000, "1234567 ²½", "x\u0085y z"]
    rows = list(enumerate(texts)) + [(8, texts[8]), (0, ""), (None, "no id")]
    df = clash(spark.createDataFrame(rows, "doc_id long, text string"))
    enc = encode.encode(df)
    got = {x.doc_id: x.ids for x in enc.collect()}
    assert enc.count() == len(texts) + 1
    for i, s in enumerate(texts):
        assert got[i] == t.encode(s or "", add_special_tokens=False).ids
    back = {x.doc_id: x.text for x in encode.decode(enc).collect()}
    assert all(back[i] == (s or "") for i, s in enumerate(texts))
    assert encode.encode(df.where("false")).count() == 0


# ---- 7 leaks ----


def test_myers_equals_the_table(spark):
    r = random.Random(9)
    for _ in range(300):
        p, t = [[r.randrange(5) for _ in range(r.randrange(1, 80))] for _ in range(2)]
        prev = [0] * (len(t) + 1)
        for i, x in enumerate(p, 1):
            cur = [i]
            for j, y in enumerate(t, 1):
                cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
            prev = cur
        assert leaks.myers(p, t) == min(prev)


def test_leaks_equal_brute_force(spark):
    r = random.Random(10)
    item = lambda: [f"w{r.randrange(60)}" for _ in range(r.randrange(7, 50))]
    items = [(i, " ".join(item())) for i in range(12)] + [(90, "too short"), (91, None), (92, "")]
    docs = []
    for d in range(120):
        w = items[r.randrange(12)][1].split()
        a, b = sorted(r.randrange(len(w) + 1) for _ in range(2))
        part = w[a:b] if r.random() < 0.7 else w[b:] + ["and"] + w[:b]
        docs.append((d, " ".join(item() + part + item())))
    docs += [(200, None), (201, ""), (None, items[0][1]), docs[0], (203, "pad " * 30_000 + items[1][1])]
    want = set()
    for d, t in docs:
        x = (t or "").split()
        for i, s in items:
            w = (s or "").split()
            grams = {tuple(x[k : k + 6]) for k in range(len(x) - 5)}
            on = {k + j for k in range(len(w) - 5) if tuple(w[k : k + 6]) in grams for j in range(6)}
            if d is not None and len(w) >= 6 and 2 * len(on) >= len(w):
                want.add((d, i))
    e = clash(spark.createDataFrame(items, "item_id long, text string"))
    df = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    got = leaks.leaks(df, e)
    assert {(x.doc_id, x.item_id) for x in got.collect()} == want and want
    assert got.count() == len(want)
    assert leaks.leaks(df.where("false"), e).count() == 0 and leaks.leaks(df, e.where("false")).count() == 0


def test_few_errors_prove_a_leak_and_others_are_looked_at(monkeypatch):
    r = random.Random(12)
    proved = 0
    for _ in range(3000):
        item = [f"w{r.randrange(200)}" for _ in range(r.randrange(7, 66))]
        w = list(item)
        for _ in range(r.randrange(0, 12)):
            k = r.randrange(len(w) + 1)
            w[k : k + r.randrange(0, 2)] = [f"x{r.randrange(99)}"] * r.randrange(0, 2)
        text = leaks._Text(" ".join(["and", *w, "then"]))
        exact = leaks.covered(item, text.grams)
        got = leaks.verify(item, text)
        assert (got is not None) == (2 * exact >= len(item))
        if got:
            assert got[0] <= exact
            proved += 0 < got[1] and leaks.least_covered(len(item), got[1]) * 2 >= len(item)
    assert proved > 100
    # the distance decides: if it were always 0, three words in common would be a leak
    item, text = "a b c d e f g h i j k l".split(), leaks._Text("x a b c y d e f z g h i")
    assert leaks.verify(item, text) is None
    monkeypatch.setattr(leaks, "myers", lambda p, t: 0)
    assert leaks.verify(item, text) is not None


def test_common_pieces_and_a_full_bitmap(spark, monkeypatch):
    e = [(i, f"how do i open the lid of pump number{i} when it is cold outside today") for i in range(40)]
    docs = [(i, f"x how do i open the lid of pump number{i % 60} when it is y") for i in range(3000)]
    df, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(e, "item_id long, text string")
    # eight words of the others' run and more: every document holds half of every item
    want = {(d, i) for d, t in docs for i, s in e if leaks.verify(leaks.printed_words(s), leaks._Text(t))}
    got = {(x.doc_id, x.item_id) for x in leaks.leaks(df, items).collect()}
    assert got == want and len(want) > 2000
    monkeypatch.setattr(bitmap, "MOST_BITS", 4)
    assert {(x.doc_id, x.item_id) for x in leaks.leaks(df, items).collect()} == want


def test_print_makes_no_difference(spark):
    s = "The final café office filters cold water every morning without any help"
    forms = [s.upper(), s.replace("fi", "ﬁ"), s.replace("é", "é"), s.replace("a", "а"), s.replace("water", "wa­ter"), s.replace("morning", "mor-\nning"), s.replace(" ", "​ 　"), s.replace(" ", ", ")]
    e = spark.createDataFrame([(1, s)], "item_id long, text string")
    df = spark.createDataFrame(list(enumerate([*forms, s.replace("é", "e")])), "doc_id long, text string")
    assert {x.doc_id for x in leaks.leaks(df, e).where("n_covered = n_words").collect()} == set(range(len(forms)))


# ---- 8 toxicity ----


def made(n, seed):
    r = random.Random(seed)
    calm = ["The {0} pump needs {1} volts.", "Use a bastard file on the {0} edge.", "Kill the {0} process first.", "The rules forbid words like moron, see {0}."]
    bad = ["You are a {0} m0r0n and nobody likes you.", "i hope you choke, you f i l t h y pig", "kill yourself, {0} idiot"]
    rows = []
    for i in range(n):
        y = r.random() < 0.3
        s = [r.choice(calm).format(f"x{r.randrange(50)}", r.randrange(90)) for _ in range(r.randrange(1, 5))] + ([r.choice(bad).format(f"x{r.randrange(50)}")] if y else [])
        r.shuffle(s)
        rows.append((i, " ".join(s), y))
    return rows


def test_held_out_accuracy_with_wrong_ratings(spark):
    rows, r = made(900, 1), random.Random(2)
    docs = [(i, t, f"s{i % 3}") for i, t, _ in rows] + [(9000, None, "s0"), (9001, "", None), (None, "kill yourself, idiot", "s1"), (9002, "calm " * 40_000, "s1"), (5, rows[5][1], "s2")]
    labels = [(i, "r", int(y) if r.random() > 0.04 else int(not y)) for i, _, y in rows[:500]] + [(3, "s", None), (None, "r", 1), (7777, "r", 1)]
    d = clash(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    l = clash(spark.createDataFrame(labels, "doc_id long, rater string, toxic int"))
    s = toxic.scores(d, l)
    got = {x.doc_id: x.score for x in s.collect()}
    assert s.count() == len(docs)
    wrong = sum((got[i] >= 0.5) != y for i, _, y in rows[500:])
    assert wrong <= 8
    assert got[9000] == got[9001] == 0.0 and got[9002] < 0.5 and got[None] >= 0.5
    rates = {x.source: (x.n_docs, x.n_flagged) for x in toxic.source_rates(s).collect()}
    assert rates["s0"][0] == 301 and rates[None] == (1, 0)
    assert toxic.scores(d.where("false"), l).count() == 0
    assert toxic.scores(d, l.where("false")).where("score >= 0.5").count() == 0


def test_disguises_come_off():
    said = [p for w in next(toxic.raw_tokens(["f.i.l.t.h.y W​anker, lossssser t1t$ d u m m y gg6189"])) if (p := toxic.plain(w))]
    assert said[:5] == ["filthy", "wanker", "loser", "tits", "dummy"] and "<id>" in said


def test_suspects_miss_no_text():
    r = random.Random(4)
    texts = ["".join(r.choice("ab  .-_*x1é") for _ in range(r.randrange(0, 30))) for _ in range(3000)] + ["", "aaa", "a b c d"]
    apart, triple = toxic.suspects(texts)
    for t, x, y in zip(texts, apart, triple):
        assert x or not toxic._SPACED.search(t)
        assert y or not toxic._LONG.search(t)


def test_sql_fits_queries():
    from grainmill.llm import queries

    assert set(queries.SQL) <= set(queries.QUERIES)
    assert {"p1_found", "p3_found", "p4_found", "p5_found", "p6_ids", "p7_found", "p8_found"} <= set(queries.QUERIES)

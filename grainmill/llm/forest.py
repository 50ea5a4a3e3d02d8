"""Groups of texts that differ by small edits, over a collection too large for pairwise comparison.

Method: an LSH forest. Every text gets several keys, each a row of min-hashes; the texts are sorted by each key, and
those with the longest common prefix are candidates: a region of few texts is compared whole, a crowded one is cut at
the next min-hash, as deep as its density asks. Candidates whose bitmaps leave it possible are compared exactly.

A forest finds nearly all links, never surely all, and a group falls apart if the one link between its halves is missed.
An exact step therefore goes over what the forest left apart: in one order of shingles, rare ones first, two texts that
share k of them have the first shared one among the first n - k + 1 of either, so the lists of these first shingles
hold every link. Only texts of different groups are compared in a list, so a group of any size costs its length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.bitmap import bitmap_of, kept
from grainmill.llm.canonical import words_text
from grainmill.operators.graph import connected_components
from grainmill.session import hot_split_join, materialize

#: Sort orders of the forest, and min-hashes of 16 bits in a key.
TREES, DEPTH = 8, 4
#: A region of more texts than this is cut at the next min-hash; where keys end, each text meets so many neighbours.
REGION, NEAR = 48, 8
#: Rows of a forest region or of a list that one task holds at most; lists expected to be longer are compared by blocks.
CROWDED = 20_000
#: The count sketch of shingles: two rows of this many counters, whatever the size of the collection. Counts only settle
#: the order of shingles, so one that is too high costs time and no link.
ROW_BITS = 19
#: Longs of a text's bitmap of shingles.
LONGS = 4
MIN_WORDS = 12
SIMILARITY = 0.5
SEED = 11

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (published splitmix64 constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the pairs of neighbouring words of each text, repeats told apart, and where each text begins."""
    words: dict[str, int] = {}
    ids: list[int] = []
    ends = [0]
    for t in texts:
        ids.extend(words.setdefault(w, len(words)) for w in t.split(" "))
        ends.append(len(ids))
    h = pd.util.hash_array(np.array(list(words), dtype=object), categorize=False).astype(np.uint64)
    w = h[np.array(ids, dtype=np.int64)]
    pair = _mix(w[:-1] * _U(3) + _mix(w[1:]))
    ends_ = np.array(ends)
    keep = np.ones(len(pair), bool)
    keep[ends_[1:-1] - 1] = False
    pair = pair[keep]
    starts = ends_[:-1] - np.arange(len(texts))
    # the k-th repeat of a pair inside one text is an element of its own
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(ends_) - 1)
    order = np.lexsort((pair, doc))
    p, d = pair[order], doc[order]
    first = np.r_[True, (p[1:] != p[:-1]) | (d[1:] != d[:-1])]
    at = np.flatnonzero(first)
    rank = np.arange(len(p)) - np.repeat(at, np.diff(np.r_[at, len(p)]))
    out = np.empty_like(pair)
    out[order] = np.where(rank == 0, p, _mix(p + rank.astype(np.uint64)))
    return out, starts


def _keys(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(texts, TREES): DEPTH min-hashes of 16 bits in each key, the first in the highest bits."""
    seeds = _mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * _U(SEED))
    out = np.zeros((len(starts), TREES), np.uint64)
    for i, seed in enumerate(seeds):
        x = (h ^ seed) * (seed | _U(1))
        low = np.minimum.reduceat(x ^ (x >> _U(32)), starts)
        out[:, i % TREES] |= (_mix(low) >> _U(48)) << _U(16 * (DEPTH - 1 - i // TREES))
    return out.view(np.int64)


def _bitmaps(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(texts, LONGS): each shingle sets one of 64 * LONGS bits."""
    place = (h & _U(64 * LONGS - 1)).astype(np.int64)
    bits = np.zeros((len(h), LONGS), np.uint64)
    bits[np.arange(len(h)), place >> 6] = _U(1) << (place & 63).astype(np.uint64)
    return np.bitwise_or.reduceat(bits, starts, axis=0).view(np.int64)


_B = [f"b{i}" for i in range(LONGS)]
_BITS = ", ".join(f"{b} long" for b in _B)


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(rep, t) to (rep, n, s, keys, b0...): shingles of each text with its keys and bitmap."""
    for big in batches:
        for at in range(0, len(big), 2048):
            b = big.iloc[at : at + 2048]
            h, starts = shingles(list(b["t"]))
            ends = np.r_[starts[1:], len(h)]
            out = pd.DataFrame({"rep": b["rep"].to_numpy(), "n": ends - starts, "s": [h[i:j].tobytes() for i, j in zip(starts, ends)], "keys": list(_keys(h, starts))})
            yield out.assign(**dict(zip(_B, _bitmaps(h, starts).T)))


# ---- which pairs can be links ----


def _least(n: np.ndarray | int, similarity: float) -> np.ndarray | int:
    """How many shingles a text of n must share at least with one that isn't longer."""
    return np.maximum(1, np.ceil(np.asarray(n) * similarity - 1e-9)).astype(np.int64)


def _possible(i: np.ndarray, j: np.ndarray, n: np.ndarray, bits: np.ndarray, similarity: float) -> np.ndarray:
    """Whether rows i and j can be similar enough. Bits that differ are shingles that only one of them has; no link is refused."""
    longer = np.maximum(n[i], n[j])
    ok = np.minimum(n[i], n[j]) >= similarity * longer
    i, j, longer = i[ok], j[ok], longer[ok]
    differ = np.bitwise_count((bits[i] ^ bits[j]).view(np.uint64)).sum(axis=1, dtype=np.int64)  # of signed numbers it counts the absolute value's
    out = ok.copy()
    out[ok] = n[i] + n[j] - differ >= 2 * _least(longer, similarity)
    return out


def _pairs_within(group: np.ndarray, most: int | None = None, first: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (i, j) of rows of one group, which stand together, by distance j - i; or up to a distance, or from ``first`` rows."""
    d, i = 1, np.arange(len(group) - 1) if first is None else first
    while len(i) and (most is None or d <= most):
        i = i[i + d < len(group)]
        i = i[group[i] == group[i + d]]  # a group goes on without gaps: what ends here has ended
        if len(i):
            yield i, i + d
        d += 1


def _held(batches: Iterator[pd.DataFrame], names: list[str], most: int) -> Iterator[pd.DataFrame]:
    """Batches cut where a group of equal names ends; a group above ``most`` rows is cut."""
    rest: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        rest.append(b)
        last = b[names].iloc[-1]
        same = (b[names] == last).all(axis=1).to_numpy()
        cut = len(b) - (len(b) if same.all() else int(same[::-1].argmin()))
        if cut or sum(map(len, rest)) > most:
            rest[-1] = b.iloc[:cut] if cut else b
            yield pd.concat(rest, ignore_index=True)
            rest = [b.iloc[cut:]] if cut else []
    if rest and sum(map(len, rest)):
        yield pd.concat(rest, ignore_index=True)


# ---- the forest ----


def _neighbours(similarity: float):
    """Scans (tree, top, key, rep, n, b0...) sorted by tree and key; (lo, hi): for each text and region its least possible partner."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _held(batches, ["tree", "top"], CROWDED):
            rep, n, bits = b["rep"].to_numpy(), b["n"].to_numpy(np.int64), b[_B].to_numpy(np.int64)
            key = b["key"].to_numpy(np.int64).view(np.uint64)
            best = rep.copy()
            todo = np.arange(len(b))
            for depth in range(1, DEPTH + 1):
                k, tree = key[todo] >> _U(16 * (DEPTH - depth)), b["tree"].to_numpy()[todo]
                new = np.r_[True, (k[1:] != k[:-1]) | (tree[1:] != tree[:-1])][: len(k)]
                region = np.cumsum(new) - 1
                size = np.bincount(region)[region] if len(region) else region
                whole = size <= REGION
                for now, most in ((whole, REGION), (~whole if depth == DEPTH else whole[:0], NEAR)):
                    at = todo[now] if len(now) else todo[:0]
                    for i, j in _pairs_within(region[now] if len(now) else region[:0], most):
                        i, j = at[i], at[j]
                        ok = (rep[i] != rep[j]) & _possible(i, j, n, bits, similarity)
                        np.minimum.at(best, i[ok], rep[j[ok]])
                        np.minimum.at(best, j[ok], rep[i[ok]])
                todo = todo[~whole]
            with_one = best < rep
            yield pd.DataFrame({"lo": best[with_one], "hi": rep[with_one]}).drop_duplicates()

    return run


def forest_pairs(sets: DataFrame, similarity: float) -> DataFrame:
    """(lo, hi): candidates of the forest, at most one for each text and sort order."""
    rows = sets.select("rep", "n", *_B, F.posexplode("keys").alias("tree", "key")).withColumn("top", F.shiftrightunsigned("key", 16 * (DEPTH - 1)))
    order = rows.repartitionByRange("tree", "key", "rep").sortWithinPartitions("tree", "key", "rep")
    return order.select("tree", "top", "key", "rep", "n", *_B).mapInPandas(_neighbours(similarity), "lo long, hi long").distinct()


# ---- the exact step ----


def _slots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    m = _U((1 << ROW_BITS) - 1)
    return (h & m).astype(np.int64), ((h >> _U(ROW_BITS)) & m).astype(np.int64) + (1 << ROW_BITS)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(2 << ROW_BITS, np.int64)
    for b in batches:
        a, c = _slots(np.frombuffer(b"".join(b["s"]), np.uint64))
        total += np.bincount(a, minlength=len(total)) + np.bincount(c, minlength=len(total))
    at = np.flatnonzero(total)
    yield pd.DataFrame({"slot": at, "n": total[at]})


def _levels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All counters as one row of bytes, on a logarithmic scale: 0 none, 1 one, from 2 on 8 steps for each doubling."""
    level = np.zeros(2 << ROW_BITS, np.uint8)
    for b in batches:
        n = b["n"].to_numpy(np.float64)
        level[b["slot"].to_numpy(np.int64)] = np.where(n < 2, 1, np.minimum(255, np.round(8 * np.log2(np.maximum(n, 2))) - 6))
    yield pd.DataFrame({"level": [level.tobytes()]})


def sketch_counts(level: bytes) -> np.ndarray:
    """The counts that the bytes of ``_levels`` stand for."""
    x = np.frombuffer(level, np.uint8).astype(np.float32)
    return np.where(x < 2, x, 2 ** ((x + 6) / 8)).astype(np.float32)


_ENTRY = ["shingle", "x", "y", "part", "rep", "n", "component", *_B]


def _listed(counts, similarity: float):
    """Rows _ENTRY: each text under the shingles that may be the first it shares with another; long lists in parts.

    Every two parts x, y of a list meet in a block of their own. The number of parts follows from the sketch, so all
    entries of a list agree on it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        level = counts.value
        for big in batches:
            for at in range(0, len(big), 2048):
                b = big.iloc[at : at + 2048]
                h = np.frombuffer(b"".join(b["s"]), np.uint64)
                n = b["n"].to_numpy(np.int64)
                doc = np.repeat(np.arange(len(b)), n)
                x, y = _slots(h)
                f = np.minimum(level[x], level[y])
                order = np.lexsort((h, f, doc))
                rank = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
                f, doc = f[order], doc[order]
                take = (rank < (n - _least(n, similarity) + 1)[doc]) & (f >= 2)  # a count of 1 is exact: no other text has it
                shingle, f, doc = h[order][take].view(np.int64), f[take], doc[take]
                parts = np.maximum(1, np.ceil(f / CROWDED)).astype(np.int64)
                rep = b["rep"].to_numpy(np.int64)
                part = (_mix(rep.view(np.uint64))[doc] % parts.astype(np.uint64)).astype(np.int64)
                again = np.repeat(np.arange(len(doc)), parts)
                other = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
                d, p = doc[again], part[again]
                out = {"shingle": shingle[again], "x": np.minimum(p, other), "y": np.maximum(p, other), "part": p, "rep": rep[d], "n": n[d], "component": b["component"].to_numpy()[d]}
                yield pd.DataFrame(out | {c: b[c].to_numpy()[d] for c in _B})

    return run


def _main_last(group: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, others): rows by group with those of its most frequent component last, and the places of the other rows."""
    order = np.lexsort((comp, group))
    g, c = group[order], comp[order]
    run = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])][: len(g)])
    size = np.diff(np.r_[run, len(g)])
    best = np.lexsort((size, g[run]))
    best = best[np.r_[g[run][best][1:] != g[run][best][:-1], True][: len(best)]]  # the longest run of each group
    main = np.zeros(len(run), bool)
    main[best] = True
    main = np.repeat(main, size)
    again = np.lexsort((main, g))
    return order[again], np.flatnonzero(~main[again])


def _apart(similarity: float):
    """Scans rows _ENTRY sorted by shingle, x and y; (lo, hi): the pairs of a list that can be links and aren't in one component."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["shingle", "x", "y"]
        for b in _held(batches, names, 1 << 62):
            k = b[names].to_numpy(np.int64)
            group = np.cumsum(np.r_[True, (k[1:] != k[:-1]).any(axis=1)]) - 1
            comp = b["component"].to_numpy(np.int64)
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            mixed = (np.minimum.reduceat(comp, starts) < np.maximum.reduceat(comp, starts))[group]
            order, others = _main_last(group[mixed], comp[mixed])  # the largest component of a list isn't compared with itself
            at = np.flatnonzero(mixed)[order]
            b, k, group, comp = b.iloc[at], k[at], group[at], comp[at]
            rep, n, bits, part = b["rep"].to_numpy(np.int64), b["n"].to_numpy(np.int64), b[_B].to_numpy(np.int64), b["part"].to_numpy(np.int64)
            across = k[:, 1] != k[:, 2]
            found = []
            for i, j in _pairs_within(group, first=others):
                ok = (comp[i] != comp[j]) & ~(across[i] & (part[i] == part[j]))
                i, j = i[ok], j[ok]
                ok = _possible(i, j, n, bits, similarity)
                i, j = rep[i[ok]], rep[j[ok]]
                found.append(np.stack([np.minimum(i, j), np.maximum(i, j)]))
            both = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
            yield pd.DataFrame({"lo": both[0], "hi": both[1]}).drop_duplicates()

    return run


def left_pairs(sets: DataFrame, similarity: float) -> DataFrame:
    """(lo, hi): of rows (rep, n, s, component, b0...) all pairs of different components that can be links."""
    slots = sets.select("s").mapInPandas(_count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    row = slots.repartition(1).mapInPandas(_levels, "level binary").first()  # 2 << ROW_BITS bytes, none for an empty table
    counts = sets.sparkSession.sparkContext.broadcast(sketch_counts(row["level"] if row else bytes(2 << ROW_BITS)))
    schema = f"shingle long, x long, y long, part long, rep long, n long, component long, {_BITS}"
    listed = sets.mapInPandas(_listed(counts, similarity), schema).repartition("shingle", "x", "y").sortWithinPartitions("shingle", "x", "y")
    return listed.mapInPandas(_apart(similarity), "lo long, hi long").distinct()


# ---- comparing and grouping ----


def _shared(similarity: float):
    """(lo, hi, n1, s1, n2, s2) to the pairs (lo, hi) that are links."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ok = [len(np.intersect1d(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), assume_unique=True)) >= similarity * max(n, m) for n, x, m, y in zip(b["n1"], b["s1"], b["n2"], b["s2"])]
            yield b.loc[np.array(ok, bool), ["lo", "hi"]]

    return run


def links_of(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(lo, hi): the written pairs that are links, by their shingles. Only the texts that stand in a pair travel."""
    ends = pairs.select(F.col("lo").alias("rep")).unionByName(pairs.select(F.col("hi").alias("rep"))).groupBy("rep").agg(F.count("*").alias("many"))
    ends = materialize(ends, "ends")
    few = kept(sets.select("rep", "n", "s"), "rep", *bitmap_of(ends, "rep")).join(ends, "rep")
    few = materialize(few, "few")
    left = few.select(F.col("rep").alias("lo"), F.col("n").alias("n1"), F.col("s").alias("s1"), "many")
    right = few.select(F.col("rep").alias("hi"), F.col("n").alias("n2"), F.col("s").alias("s2"), "many")
    both = hot_split_join(hot_split_join(pairs, left, "lo", "many"), right, "hi", "many")
    return both.select("lo", "hi", "n1", "s1", "n2", "s2").mapInPandas(_shared(similarity), "lo long, hi long")


def components(reps: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(rep, component) for rows (rep, t) of different texts: all that is linked directly or through others."""
    sets = materialize(reps.select("rep", "t").mapInPandas(_signed, f"rep long, n int, s binary, keys array<long>, {_BITS}"), "sets")
    near = materialize(links_of(materialize(forest_pairs(sets, similarity), "near"), sets, similarity), "links")
    first = materialize(connected_components(near, "lo", "hi").select(F.col("node").alias("rep"), "component"), "components")
    placed = sets.drop("keys").join(first, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    apart = materialize(links_of(materialize(left_pairs(placed, similarity), "apart"), sets, similarity), "links")
    # the links between components join these
    named = sets.select("rep").join(first, "rep", "left").select("rep", F.coalesce("component", "rep").alias("was"))
    ends = apart.join(named.select(F.col("rep").alias("lo"), F.col("was").alias("a")), "lo").join(named.select(F.col("rep").alias("hi"), F.col("was").alias("b")), "hi")
    joined = materialize(connected_components(ends.select("a", "b"), "a", "b").select(F.col("node").alias("was"), "component"), "components")
    return named.join(joined, "was", "left").select("rep", F.coalesce("component", "was").alias("component")).distinct()


def texts_of(records: DataFrame, id_col: str = "answer_id", text_col: str = "a", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, k, t): the words of each text of at least ``min_words`` words and a key equal for equal word sequences."""
    t = records.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), words_text(text_col).alias("t"))
    return t.where(F.length("t") - F.length(F.translate("t", " ", "")) >= min_words - 1).withColumn("k", F.md5("t"))


def near_groups(records: DataFrame, id_col: str = "answer_id", text_col: str = "a", min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Rows (id, group_id): one row for every text of at least ``min_words`` words.

    The similarity of two texts is the number of pairs of neighbouring words they share (each as often as both have
    it) over the number of such pairs in the longer one. Texts at ``similarity`` or more are linked; a group is all
    that is linked directly or through others, named by its least id; a text without partner is a group of its own.
    Texts with the same words in the same order are one node. Null, blank and short texts take no part. A repeated id
    counts once; should its deliveries differ, it takes the group of each of its texts. Rows with a null id are left
    out. An empty table gives no rows.
    """
    texts = materialize(texts_of(records, id_col, text_col, min_words), "texts")
    same = materialize(texts.groupBy("k").agg(F.min("id").alias("rep"), F.first("t").alias("t"), F.count("*").alias("n")), "same")
    named = same.select("k", "rep", "n").join(components(same, similarity), "rep").select("k", "n", F.col("component").alias("group_id"))
    return hot_split_join(texts.select("id", "k"), materialize(named, "named"), "k", "n").select(F.col("id").alias(id_col), "group_id").distinct()


def group_pairs(groups: DataFrame, id_col: str = "answer_id", lo: str = "id_lo", hi: str = "id_hi") -> DataFrame:
    """Rows (lo, hi): every two ids of one group, smaller first. The output itself is quadratic in a group; the larger
    side of each group is spread by id, so no task builds all pairs of a large group alone."""
    g = groups.select("group_id", F.col(id_col).alias("id")).distinct()
    sizes = g.groupBy("group_id").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(g.join(sizes, "group_id"), "members")
    # 1 part for groups up to 2000 members, more for larger ones
    parts = F.ceil(F.col("n") / 2000).cast("int")
    left = members.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    right = members.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    a, b = left.select("group_id", "part", F.col("id").alias(lo)), right.select("group_id", "part", F.col("id").alias(hi))
    return a.join(b, ["group_id", "part"]).where(F.col(lo) < F.col(hi)).select(lo, hi)

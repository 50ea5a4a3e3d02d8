"""Near repeats with their places, found block against block, so that no pair of texts is ever shuffled."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.functions.text import tokens
from grainmill.session import materialize

#: Two texts are near when they share at least WHOLE/PARTS of the smaller word set.
PARTS, WHOLE = 4, 3
#: Words and texts of a block, about; blocks of a small table, so that there are tasks enough.
BLOCK_WORDS, BLOCK_TEXTS, LEAST_BLOCKS = 2_500_000, 50_000, 5
#: Word sets up to SHORT are counted by bitsets, those above WIDE by a scan of the block, the others meet by slots.
SHORT, WIDE = 16, 512
#: Classes of words; a slot is two words of one class.
CLASSES = 16
#: Short texts whose words are bitsets at once; candidates that are compared at once.
BATCH, CHUNK = 1024, 1_000_000

_PAIRS = "block int, a int, b int, shared int, smaller int"
_RANKED = "place long, a string, b string, similarity double"


def _read(uri: str, *columns: str) -> pa.Table:
    fs, path = FileSystem.from_uri(uri)
    return pq.ParquetFile(fs.open_input_file(path)).read(list(columns))


def _at_least(n: np.ndarray | int):
    """The fewest words that a set of n words must share."""
    return -(-n * WHOLE // PARTS)


def _spans(lo: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers lo, lo + 1, ... of each span, one span after the other."""
    return np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())


class _Side:
    """The texts of a block: ``key`` is row * v + word, sorted; ``row``, ``word``, ``n`` (words of each row), ``start``."""

    def __init__(self, words: np.ndarray, n: np.ndarray, known: np.ndarray) -> None:
        self.v, self.r, self.n = len(known), len(n), n
        self.key = np.sort(np.repeat(np.arange(self.r), n) * self.v + np.searchsorted(known, words))
        self.row, self.word = np.divmod(self.key, self.v)
        self.start = np.cumsum(n) - n
        self.kind = (known.view(np.uint64) >> np.uint64(20)).astype(np.int64) % CLASSES
        by_word = np.sort(self.word * self.r + self.row)
        self.at = np.searchsorted(by_word, np.arange(self.v + 1) * self.r)
        self.rows_of, self.df = by_word % self.r, np.diff(self.at)
        seen = np.zeros((self.r, 256), np.uint8)
        seen[self.row, (known.view(np.uint64) >> np.uint64(40)).astype(np.int64)[self.word] % 256] = 1
        self.bits = np.packbits(seen, axis=1, bitorder="little").view(np.uint64).T.copy()


def _larger(s: _Side, g: _Side, i: np.ndarray, j: np.ndarray, before: bool | None) -> np.ndarray:
    """Where j's set is the larger; of equal sizes the later text is. before: s lies before g (None: the same block)."""
    return (g.n[j] > s.n[i]) | ((g.n[j] == s.n[i]) & (i < j if before is None else before))


def _short(s: _Side, g: _Side, before: bool | None) -> Iterator[tuple]:
    """(i, j, shared): sets of at most SHORT words, each counted in all sets of g at once, 64 to a machine word."""
    rows = np.flatnonzero(s.n <= SHORT)
    width, place = -(-g.r // 64), np.empty(s.v, np.int64)
    for k in range(0, len(rows), BATCH):
        part = rows[k : k + BATCH]
        u = np.unique(s.word[_spans(s.start[part], s.n[part])])
        place[u] = -1
        u = u[g.df[u] > 0]
        place[u] = np.arange(len(u))
        bits = np.zeros((len(u), width * 8), np.uint8)
        if len(u):
            r = g.rows_of[_spans(g.at[u], g.df[u])]
            byte = np.repeat(np.arange(len(u)) * (width * 8), g.df[u]) + (r >> 3)
            first = np.flatnonzero(np.diff(byte, prepend=-1))
            bits.reshape(-1)[byte[first]] = np.bitwise_or.reduceat((1 << (r & 7)).astype(np.uint8), first)
        bits = bits.view(np.uint64)
        for i in part.tolist():
            m = int(s.n[i])
            own = place[s.word[s.start[i] : s.start[i] + m]]
            own = own[own >= 0]
            # alive[d]: the sets that lack at most d of the words so far; None stands for all of them
            most = len(own) - _at_least(m)
            if most < 0:
                continue
            alive: list = [None] * (most + 1)
            for w in own.tolist():
                for d in range(most, 0, -1):
                    if alive[d - 1] is not None:
                        alive[d] = bits[w] | alive[d - 1] if alive[d] is None else (alive[d] & bits[w]) | alive[d - 1]
                alive[0] = bits[w] if alive[0] is None else alive[0] & bits[w]
            some = np.flatnonzero(alive[most])
            if not len(some):
                continue
            at, bit = np.nonzero(np.unpackbits(alive[most][some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            j = some[at] * 64 + bit
            j = j[_larger(s, g, np.full(len(j), i), j, before)]
            shared = np.full(len(j), len(own) - most)
            for d in range(most):
                shared += (alive[d][j >> 6] >> (j & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)
            yield np.full(len(j), i), j, shared


def _slots(s: _Side, g: _Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word, other word or -1) of the slots of each set of SHORT < n <= WIDE words.

    Slots are disjoint. A set that may lack e words has e + 1 of them, so every set it is near to holds one whole. Words
    of one class pair up, rare ones first; the slots that are rarest in g are taken.
    """
    own = np.flatnonzero((s.n[s.row] > SHORT) & (s.n[s.row] <= WIDE))
    group, df = s.row[own] * CLASSES + s.kind[s.word[own]], g.df[s.word[own]]
    order = np.argsort(group * (g.r + 1) + df)
    group, df, word = group[order], df[order], s.word[own][order]
    first = np.diff(group, prepend=-1) != 0
    pos = np.arange(len(group)) - np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
    p = np.flatnonzero(pos % 2 == 0)
    last = len(group) - 1
    paired = (p < last) & (group[np.minimum(p + 1, last)] == group[p])
    other = np.where(paired, word[np.minimum(p + 1, last)], -1)
    cost = df[p] * np.where(paired, df[np.minimum(p + 1, last)] / max(g.r, 1), 1.0)
    row = group[p] // CLASSES
    best = np.lexsort((cost, row))
    row, word, other = row[best], word[p][best], other[best]
    first = np.diff(row, prepend=-1) != 0
    rank = np.arange(len(row)) - np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
    keep = rank <= s.n[row] - _at_least(s.n[row])
    return row[keep], word[keep], other[keep]


def _compared(s: _Side, g: _Side, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, found: np.ndarray, before: bool | None) -> Iterator[np.ndarray]:
    """i * r + j of the candidates that the bitmaps of the sets leave."""
    count = hi - lo
    some = count > 0
    row, lo, count = row[some], lo[some], count[some]
    total, may_lack = np.cumsum(count), s.n - _at_least(s.n)
    k = 0
    while k < len(row):
        e = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + CHUNK)))
        i, j = np.repeat(row[k:e], count[k:e]), found[_spans(lo[k:e], count[k:e])]
        k = e
        # words of i that j lacks: half of the bitmap ends most candidates
        lacks = np.bitwise_count(s.bits[0][i] & ~g.bits[0][j]).astype(np.int16) + np.bitwise_count(s.bits[1][i] & ~g.bits[1][j])
        ok = lacks <= may_lack[i]
        i, j, lacks = i[ok], j[ok], lacks[ok]
        lacks += np.bitwise_count(s.bits[2][i] & ~g.bits[2][j]) + np.bitwise_count(s.bits[3][i] & ~g.bits[3][j])
        ok = (lacks <= may_lack[i]) & _larger(s, g, i, j, before) & (g.n[j] <= WIDE)
        yield np.unique(i[ok] * g.r + j[ok])


def _long(s: _Side, g: _Side, before: bool | None) -> Iterator[tuple]:
    """(i, j, shared): sets of SHORT < n <= WIDE words, which meet by a slot; what the bitmaps leave is counted."""
    row, word, other = _slots(s, g)
    if not len(row):
        return
    own = np.flatnonzero((g.n[g.row] > SHORT) & (g.n[g.row] <= WIDE))
    group, w = np.divmod(np.sort((g.row[own] * CLASSES + g.kind[g.word[own]]) * g.v + g.word[own]), g.v)
    known, d = [np.empty(0, np.int64)], 1
    while (same := np.flatnonzero(group[:-d] == group[d:])).size:
        known.append((w[same] * g.v + w[same + d]) * g.r + group[same] // CLASSES)
        d += 1
    held = np.sort(np.concatenate(known))
    two = other >= 0
    pair = np.minimum(word, other)[two] * g.v + np.maximum(word, other)[two]
    order = np.argsort(pair)
    pair, pair_row = pair[order], row[two][order]
    left = [*_compared(s, g, pair_row, np.searchsorted(held, pair * g.r), np.searchsorted(held, (pair + 1) * g.r), held % g.r, before)]
    left += _compared(s, g, row[~two], g.at[word[~two]], g.at[word[~two] + 1], g.rows_of, before)
    left = np.unique(np.concatenate([np.empty(0, np.int64), *left]))
    step = CHUNK // WIDE
    for k in range(0, len(left), step):
        i, j = np.divmod(left[k : k + step], g.r)
        want = np.repeat(j, s.n[i]) * g.v + s.word[_spans(s.start[i], s.n[i])]
        has = g.key[np.minimum(np.searchsorted(g.key, want), len(g.key) - 1)] == want
        shared = np.add.reduceat(has.astype(np.int64), np.cumsum(s.n[i]) - s.n[i])
        ok = shared >= _at_least(s.n[i])
        yield i[ok], j[ok], shared[ok]


def _wide(s: _Side, g: _Side, before: bool | None) -> Iterator[tuple]:
    """(i, j, shared): sets j of more than WIDE words, each held against all sets of more than SHORT words."""
    for j in np.flatnonzero(g.n > WIDE).tolist():
        mark = np.zeros(s.v, np.int64)
        mark[g.word[g.start[j] : g.start[j] + g.n[j]]] = 1
        shared = np.add.reduceat(mark[s.word], s.start)
        i = np.flatnonzero((shared >= _at_least(s.n)) & (s.n > SHORT))
        i = i[_larger(s, g, i, np.full(len(i), j), before)]
        yield i, np.full(len(i), j), shared[i]


def block_pairs(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """Columns a (row of the first block), b (of the second), shared, smaller; a block is (words, number of each row).

    With None the block is held against itself. Rows go by a, then b; each pair comes once.
    """
    if not len(one[1]) or two is not None and not len(two[1]):
        return np.empty((0, 4), np.int64)
    known = np.unique(one[0]) if two is None else np.union1d(one[0], two[0])
    s = _Side(*one, known)
    g = s if two is None else _Side(*two, known)
    got = [np.empty((0, 4), np.int64)]
    for x, y, before in [(s, s, None)] if two is None else [(s, g, True), (g, s, False)]:
        for way in (_short, _long, _wide):
            for i, j, shared in way(x, y, before):
                a, b = (np.minimum(i, j), np.maximum(i, j)) if before is None else (i, j) if before else (j, i)
                got.append(np.stack([a, b, shared, x.n[i]], axis=1))
    p = np.concatenate(got)
    return p[np.lexsort((p[:, 1], p[:, 0]))]


def _block(uri: str) -> tuple[np.ndarray, np.ndarray]:
    w = _read(uri, "w")["w"].combine_chunks()
    return w.flatten().to_numpy(zero_copy_only=False), np.asarray(w.value_lengths()).astype(np.int64)


def _of_task(t: int, blocks: int) -> tuple[int, int]:
    """The two blocks of a task, the first not after the second."""
    a = 0
    while t >= blocks - a:
        t, a = t - (blocks - a), a + 1
    return a, a + t


def _task(a: int, b: int, blocks: int) -> int:
    return a * blocks - a * (a - 1) // 2 + b - a


def _found(files: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in (t for x in batches for t in x.column("id").to_pylist()):
            a, b = _of_task(t, len(files))
            p = block_pairs(_block(files[a]), None if a == b else _block(files[b])).astype(np.int32)
            for k in range(0, len(p), 100_000):
                q = p[k : k + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(q), a, np.int32), *np.ascontiguousarray(q.T))], ["block", "a", "b", "shared", "smaller"])

    return run


def _sum_by(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, at = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(at, np.concatenate(counts), len(k)).astype(np.int64)


def _placed(files: list[str], pairs: dict[int, str], totals: list[str]):
    """The pairs of two blocks with their places.

    Before a pair come all of higher similarity, then those of its similarity whose a lies in a later block, then is a
    later text, then those of the same a whose b lies in a later block, then is a later text. So a task counts the pairs
    of its first block with every other block, and has the sums of the blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in (t for x in batches for t in x.column("id").to_pylist()):
            if t not in pairs:
                continue
            a, b = _of_task(t, len(files))
            x = pa.concat_tables(_read(f, "block", "shared", "smaller", "n") for f in totals)
            block, shared, smaller, n = (x[c].to_numpy() for c in ("block", "shared", "smaller", "n"))
            steps, at = np.unique(-(shared / smaller), return_inverse=True)
            sums = np.bincount(at, n, len(steps)).astype(np.int64)
            base = np.cumsum(sums) - sums + np.bincount(at[block > a], n[block > a], len(steps)).astype(np.int64)
            first, second = _read(files[a], "x")["x"].combine_chunks(), _read(files[b], "x")["x"].combine_chunks()
            r = len(first)

            def cells(p: pa.Table, steps=steps, r=r) -> np.ndarray:
                return np.searchsorted(steps, -(p["shared"].to_numpy() / p["smaller"].to_numpy())) * r + (r - 1 - p["a"].to_numpy())

            every, later = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in range(2)]
            for c in range(a, len(files)):
                if (u := _task(a, c, len(files))) in pairs:
                    more = np.unique(cells(_read(pairs[u], "a", "shared", "smaller")), return_counts=True)
                    every = _sum_by([every[0], more[0]], [every[1], more[1]])
                    later = _sum_by([later[0], more[0]], [later[1], more[1]]) if c > b else later
            p = _read(pairs[t], "a", "b", "shared", "smaller")
            cell, pa_, pb = cells(p), p["a"].to_numpy(), p["b"].to_numpy()
            step = every[0] // r
            before = np.cumsum(every[1]) - every[1]
            before += base[step] - before[np.searchsorted(step, step)]
            at = np.searchsorted(every[0], later[0])
            before[at] += later[1]
            order = np.lexsort((-pb, cell))
            cell, pa_, pb = cell[order], pa_[order], pb[order]
            new = np.diff(cell, prepend=-1) != 0
            inside = np.arange(len(cell)) - np.maximum.accumulate(np.where(new, np.arange(len(cell)), 0))
            place, similarity = before[np.searchsorted(every[0], cell)] + inside + 1, -steps[cell // r]
            # rows of one long text lie together, which keeps the written result small
            sizes = [np.asarray(pc.binary_length(x)) for x in (first, second)]
            order = np.argsort(np.where(sizes[0][pa_] >= sizes[1][pb], pa_, r + pb), kind="stable")
            for k in range(0, len(order), 10_000):
                o = order[k : k + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(place[o]), first.take(pa.array(pa_[o])), second.take(pa.array(pb[o])), pa.array(similarity[o])], ["place", "a", "b", "similarity"])

    return run


def _numbered(df: DataFrame) -> dict[int, str]:
    """The files of a written table by the number of the task that wrote them."""
    return {int(re.search(r"part-(\d+)", f.rpartition("/")[2])[1]): f for f in df.inputFiles()}


def ranked_near_pairs(texts: DataFrame, text: str = "a") -> DataFrame:
    """(place, a, b, similarity): the pairs of ``near_pairs`` by falling similarity, then falling texts.

    The texts are sorted into blocks, written once with the hashes of their words. A task holds two blocks against each
    other and writes the pairs as row numbers; as many tasks read these again, know the places from counts, and put the
    texts in. Only the texts are shuffled, so the disk used beside the result is a few bytes for a pair. Words count as
    equal when their 64-bit hashes are. Tasks read the written tables from the shared folder themselves.
    """
    spark = texts.sparkSession
    words = F.array_distinct(F.transform(tokens(F.trim(F.lower(F.col("x")))), lambda w: F.xxhash64(w)))
    once = materialize(texts.select(F.col(text).alias("x")).where("x is not null").distinct(), "once")
    size = once.agg(F.count("*").alias("n"), F.sum(F.length("x")).alias("c")).first()
    # a word and its blank are six characters, about
    blocks = max(LEAST_BLOCKS, -(-size["n"] // BLOCK_TEXTS), -(-(size["c"] or 0) // (6 * BLOCK_WORDS)))
    parts = once.repartitionByRange(blocks, "x").select("x", words.alias("w")).where(F.size("w") > 0).sortWithinPartitions("x")
    numbered = _numbered(materialize(parts, "blocks"))
    files = [numbered[k] for k in sorted(numbered)]
    n = len(files) * (len(files) + 1) // 2
    tasks = spark.range(0, n, 1, max(1, n))
    pairs = materialize(tasks.mapInArrow(_found(files), _PAIRS), "pairs")
    totals = materialize(pairs.groupBy("block", "shared", "smaller").agg(F.count("*").alias("n")), "totals")
    return tasks.mapInArrow(_placed(files, _numbered(pairs), totals.inputFiles()), _RANKED)


__all__ = ["block_pairs", "ranked_near_pairs"]

"""Evaluation passages that got into training texts, whole or in part.

Method: pigeonhole edit matching. An item of n words may suffer n div PIECE - 1 word errors, its error budget, and is cut
into one piece more than that, so that one is always intact. Exact hits of pieces in the texts give candidates, and
Myers' bit-parallel distance verifies them: few enough errors prove that half of the words stand in runs, too many that
no run does; between the two the runs are looked for exactly.

Items are a table like the documents: pieces meet by a join, and only a bitmap of bounded size goes to every executor.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainmill.llm.bitmap import bitmap_of, has, kept
from grainmill.session import hot_split_join, materialize

#: Words of a piece. A run of RUN or more shared words always holds a whole piece, as PIECE <= (RUN + 1) / 2.
PIECE = 3
RUN = 6
#: The share of an item's words that must lie in such runs.
SHARE = 0.5
# Letters of other scripts that print like Latin ones.
LOOKALIKES = str.maketrans("аеорсухіјѕһԁԛԝӏтмнквοανρτυικχεγ", "aeopcyxijshdqwltmhkboavptuikxey")
_WORD = re.compile(r"[^\W_]+")
_PLAIN = re.compile("[a-z0-9]+")
_BROKEN = re.compile(r"(?<=[^\W\d_])[-‐‑­]\s*\n\s*(?=[^\W\d_])")
_LATIN = re.compile("[a-zß-ɏ]")


def printed_words(text: str) -> list[str]:
    """The words of a text as a reader of its print sees them.

    Compatibility forms, letter case, invisible characters, composed or decomposed accents, words broken at a line end
    and look-alike letters of other scripts inside a Latin word make no difference; accents do.
    """
    t = _BROKEN.sub("", text) if "\n" in text else text
    if t.isascii():
        return _PLAIN.findall(t.lower())
    t = unicodedata.normalize("NFKC", t).casefold()
    if not t.isascii():
        t = unicodedata.normalize("NFC", "".join(c for c in t if c.isascii() or (unicodedata.category(c) != "Cf" and c != "̇" and not "︀" <= c <= "️")))
        t = t.replace("œ", "oe").replace("æ", "ae")
    words = _WORD.findall(t)
    if t.isascii():
        return words
    return [w if w.isascii() else _latin(w) for w in words]


def _latin(w: str) -> str:
    m = w.translate(LOOKALIKES)
    if m != w and (_LATIN.search(w) or m.isascii()):
        return m
    return w


def myers(pattern: list, text: list) -> int:
    """The least number of word edits between the pattern and any stretch of the text, bit-parallel."""
    m = len(pattern)
    peq: dict = {}
    for i, w in enumerate(pattern):
        peq[w] = peq.get(w, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = mask, 0, m, m
    for w in text:
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & mask
        mh = (mh << 1) & mask
        pv = (mh | ~(xv | ph)) & mask
        mv = ph & xv
        best = min(best, score)
    return best


def covered(item: list, grams: set) -> int:
    """How many words of the item lie in runs of RUN or more that also stand in a row in the text with these grams."""
    inside = bytearray(len(item))
    for k in range(len(item) - RUN + 1):
        if tuple(item[k : k + RUN]) in grams:
            inside[k : k + RUN] = b"\x01" * RUN
    return sum(inside)


def least_covered(n: int, edits: int) -> int:
    """How many of n words stand in runs of RUN or more at least, if so many errors turn them into a stretch of a text.

    The errors leave n - edits words or more in edits + 1 runs at most, of which the short ones have RUN - 1 words each.
    """
    return n if edits == 0 and n >= RUN else max(0, n - edits - (RUN - 1) * (edits + 1))


def least_pieces(n: int) -> int:
    """How many of its pieces are intact at least, if SHARE of n words stand in runs: a run of 2 * RUN - 5 words may hold one only."""
    return max(1, math.ceil(SHARE * n / (2 * RUN - 5)))


def _hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every three neighbouring words of the texts, by the place of the first, and where each text begins and ends.

    The last two places of a text hold three words that go on in the next one.
    """
    words: list[str] = []
    ends = [0]
    for t in texts:
        words += printed_words(t)
        ends.append(len(words))
    coded = pa.array(words, pa.string()).dictionary_encode()
    h = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False).astype(np.uint64)[coded.indices.to_numpy()]
    x = h[: len(h) - PIECE + 1] if len(h) >= PIECE else h[:0]
    for d in range(1, PIECE):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[d : d + len(x)]
    return (x ^ (x >> np.uint64(32))).view(np.int64), np.array(ends)


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(item, k, t) to (item, k, piece, m): the pieces of items of RUN words or more, and how many of them a leak holds at least."""
    for b in batches:
        x, ends = _hashes(list(b["t"]))
        out = []
        for item, k, s, e in zip(b["item"], b["k"], ends, ends[1:]):
            if e - s >= RUN:
                out += [(item, k, p, least_pieces(e - s)) for p in dict.fromkeys(x[s : e - PIECE + 1 : PIECE].tolist())]
        yield pd.DataFrame(out, columns=["item", "k", "piece", "m"])


def _hits(bitmap, bits: int):
    """(id, h, t) to (id, h, piece): every different three words of a text that the bitmap has."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x, ends = _hashes(list(b["t"]))
            at = np.flatnonzero(has(bitmap.value, bits, x))
            of = np.searchsorted(ends, at, "right") - 1
            inside = at + PIECE <= ends[of + 1]
            yield b[["id", "h"]].iloc[of[inside]].assign(piece=x[at[inside]]).drop_duplicates()

    return run


class _Text:
    """The words of a text, with the places of its three-word stretches."""

    def __init__(self, text: str) -> None:
        self.words = printed_words(text)
        self.at: dict[tuple, list[int]] = {}
        for i, g in enumerate(zip(*[self.words[d:] for d in range(PIECE)])):
            self.at.setdefault(g, []).append(i)
        self._grams: set | None = None

    @property
    def grams(self) -> set:
        if self._grams is None:
            self._grams = set(zip(*[self.words[d:] for d in range(RUN)]))
        return self._grams


def verify(item: list[str], text: _Text) -> tuple[int, int] | None:
    """(words covered, least number of word edits) if the text leaks the item, else None.

    With few errors the words covered are the number that is certain, else the exact one.
    """
    n = len(item)
    diagonals = {(at - p) // n for p in range(0, n - PIECE + 1, PIECE) for at in text.at.get(tuple(item[p : p + PIECE]), ())}
    edits = n
    for d in diagonals:  # windows around the hits, each verified once
        edits = min(edits, myers(item, text.words[max(0, d * n - n // 2) : d * n + 2 * n + n // 2]))
    if edits > n - RUN:
        return None
    sure = least_covered(n, edits)
    if sure >= SHARE * n:
        return sure, edits
    c = covered(item, text.grams)
    return (c, edits) if c >= SHARE * n else None


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows, last, text, items = [], None, _Text(""), {}
        for doc, h, t, i, s in zip(b["id"], b["h"], b["t"], b["item"], b["s"]):
            if (doc, h) != last:
                last, text = (doc, h), _Text(t)
            if s not in items:
                items[s] = printed_words(s)
            if found := verify(items[s], text):
                rows.append((doc, i, len(items[s]), *found))
        yield pd.DataFrame(rows, columns=["id", "item", "n_words", "n_covered", "edits"])


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (doc_id, item_id, n_words, n_covered, edits): documents that hold at least half of an item's words in runs of six or more.

    ``edits`` is the least number of word edits between the item and a stretch of the document; where these are few
    enough to prove the leak, ``n_covered`` is the number of covered words that they make certain, else the exact one.
    Null and empty texts and items of fewer than six words give nothing. Rows with a null id are left out; repeated ids
    or rows give one row each pair of ids, with the greatest cover. Empty tables give no rows.

    A leak holds some number m of its item's pieces, so one of all but the m - 1 commonest is among them: only those
    are joined. Pieces that many documents hold are salted. A bitmap of the candidates drops other texts before any text
    travels.
    """
    spark = docs.sparkSession
    src = items.where(F.col(item_text).isNotNull() & F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("item"), F.xxhash64(item_text).alias("k"), F.col(item_text).alias("t")).distinct()
    base = docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t"))
    pieces = materialize(src.mapInPandas(_pieces, "item long, k long, piece long, m int"), "pieces")
    bitmap, bits = bitmap_of(pieces, "piece")
    hits = materialize(base.mapInPandas(_hits(bitmap, bits), "id long, h long, piece long"), "hits")
    often = hits.groupBy("piece").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("item", "k").orderBy(F.desc("n"), "piece"))  # an item's pieces
    rare = pieces.join(often, "piece", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("r", rank).where("r >= m and n > 0")
    lookup = materialize(rare.groupBy(F.col("piece").cast("string").alias("piece")).agg(F.max("n").alias("n"), F.collect_list(F.struct("item", "k")).alias("of")), "lookup")
    met = hot_split_join(hits.withColumn("piece", F.col("piece").cast("string")), lookup, "piece", "n", keep_key=False)
    cand = materialize(met.select("id", "h", F.inline("of")).distinct(), "candidates")
    both = kept(base, "h", *bitmap_of(cand, "h")).join(cand, ["id", "h"]).join(src.select("item", "k", F.col("t").alias("s")), ["item", "k"])
    found = both.select("id", "h", "t", "item", "s").mapInPandas(_verify, "id long, item long, n_words long, n_covered long, edits long")
    best = found.groupBy("id", "item").agg(F.max(F.struct("n_covered", "n_words", F.negative("edits").alias("e"))).alias("b"))
    return best.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "b.n_words", "b.n_covered", (-F.col("b.e")).alias("edits"))

"""Scores for abusive, hateful or sexually explicit content, and the rate of such documents per source.

Method: FTRL-proximal logistic regression over hashed word n-grams and skip-grams. Each coordinate has its own learning
rate and an L1 penalty keeps the weights few, so they can be broadcast. A text's score is that of its worst passage;
since the ratings are for whole documents, training picks the passages that explain a rating in a few rounds.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The classifier is fitted on one executor, on at most so many rated documents, taken in hash order, none of them longer
#: than so many characters; both bound its memory, and ratings beyond them aren't needed for a model of this size.
MAX_TRAINING_DOCS = 20_000
MAX_TRAINING_CHARS_EACH = 20_000
#: Features are hashed to 2^BITS coordinates, so a model never has more weights than that.
BITS = 20
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.6, 0.5
ROUNDS, EPOCHS, BATCH = 3, 3, 64
#: Log odds that the worst passage of a positive text must reach, by round, and those from which a negative text is doubted.
LEAST, MOST = (-2.5, -1.5, -1.0), 2.0
#: The border between the classes lies this far above the calm texts, but not below FLOOR.
MARGIN, FLOOR = 0.6, -2.2
#: A text is flagged from this score on.
THRESHOLD = 0.5
SEED = 7

# Characters that stand for letters in disguised words.
DISGUISE = str.maketrans("0134578@$!|€+", "oieastbasiiet")
_ZERO = re.compile("[\u200b-\u200f\u2060\ufeff\u00ad\u180e]")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .\-_*·]){3,}[^\W\d_](?![^\W_])")
_SPACER = re.compile(r"[ .\-_*·]")
_LONG = re.compile(r"([^\W\d_])\1{2,}")
#: A word, perhaps with marks in place of letters, or an end of a passage.
_TOKEN = re.compile(r"[^\W_][^\W_@$!|*€+]*(?:[@$!|*€+]+[^\W_]+)*[@$]*|[@$][^\W_]+(?:[@$!*]+[^\W_]*)*|[.!?。؟…;\n\r]+")
_STOPS = frozenset(".!?。؟…;\n\r")
_MASK = re.compile(r"[^\W_]\*+[^\W_]")
_NAMED = re.compile(r"[^\W\d_]+\d{3,}")


def plain(w: str) -> str:
    """A word with the usual disguises taken off; an end of a passage gives ''."""
    if w.isalpha() and w.isascii():
        return w
    if w[0] in _STOPS:
        return ""
    if _MASK.search(w):
        return "<masked>"
    if w.isdigit():
        return "<n>"
    if any(c.isalpha() for c in w):
        if not w.isalpha():
            if _NAMED.fullmatch(w):
                return "<id>"
            if sum(c.isdigit() for c in w) < len(w) / 1.5:
                w = w.translate(DISGUISE)
        w = "".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.combining(c))
    return w


def _joined(m: re.Match) -> str:
    """A word written letter by letter; its first letter may be a word of its own (a, i), so both readings are given."""
    w = _SPACER.sub("", m[0])
    return f"{w} {w[1:]}" if w[0] in "ai" and len(w) > 4 else w


def suspects(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Which of the texts may have letters written apart, and which a letter three times in a row; all that aren't ASCII."""
    ascii_ = np.array([t.isascii() for t in texts], bool)
    size = np.array([len(t) + 1 if a else 1 for t, a in zip(texts, ascii_)], np.int64)
    x = np.frombuffer("\n".join([t if a else "" for t, a in zip(texts, ascii_)] + [""]).encode(), np.uint8)
    letter = (x >= 97) & (x <= 122)
    gap = np.isin(x, np.frombuffer(b" .-_*", np.uint8))
    step = letter[:-1] & gap[1:]  # a letter and what parts it from the next
    apart = step[:-5] & step[2:-3] & step[4:-1] & letter[6:]
    triple = letter[2:] & (x[:-2] == x[1:-1]) & (x[1:-1] == x[2:])
    ends = np.cumsum(size)
    out = []
    for hit in (apart, triple):
        at = np.zeros(len(texts), bool)
        at[np.searchsorted(ends, np.flatnonzero(hit), "right")] = True
        out.append(at | ~ascii_)
    return out[0], out[1]


def raw_tokens(texts: list[str]) -> Iterator[list[str]]:
    """The words of each text as they stand there, and its ends of passages: sentences and lines."""
    low = [t.lower() if t.isascii() else unicodedata.normalize("NFKC", _ZERO.sub("", t)).casefold() for t in texts]
    for t, apart, triple in zip(low, *suspects(low)):
        if apart:
            t = _SPACED.sub(_joined, t)
        if triple:
            t = _LONG.sub(r"\1", t)
        yield _TOKEN.findall(t)


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of all passages, the passage of each feature, and the text of each passage.

    A passage has its words, pairs of neighbouring words, and pairs with one or two words between (skip-grams).
    """
    words: list[str] = []
    sizes: list[int] = []
    for w in raw_tokens(texts):
        words += w
        words.append("\n")
        sizes.append(len(w) + 1)
    coded = pa.array(words, pa.string()).dictionary_encode()
    plains = np.array([plain(w) for w in coded.dictionary.to_pylist()], dtype=object)
    at = coded.indices.to_numpy()
    h = pd.util.hash_array(plains, categorize=False).astype(np.uint64)[at]
    stop = (plains == "").astype(bool)[at]
    keep = ~stop
    h, pas, own = h[keep], np.cumsum(stop)[keep], np.repeat(np.arange(len(texts)), sizes)[keep]
    new = np.r_[True, pas[1:] != pas[:-1]][: len(pas)]
    pas, owner = np.cumsum(new) - 1, own[new]
    parts, where = [h], [pas]
    for gap in (1, 2, 3):
        a, b = h[:-gap], h[gap:]
        same = pas[:-gap] == pas[gap:]
        x = (a[same] * np.uint64(0x9E3779B97F4A7C15) ^ (b[same] + np.uint64(min(gap, 2)))) * np.uint64(0xBF58476D1CE4E5B9)
        parts.append(x ^ (x >> np.uint64(29)))
        where.append(pas[:-gap][same])
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(where), owner


def once(f: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every feature once in a passage, however often it repeats, in order of passages."""
    both = np.sort((where << BITS) | f)  # several times as fast as np.unique, which hashes
    both = both[np.r_[True, both[1:] != both[:-1]][: len(both)]]
    return both & ((1 << BITS) - 1), both >> BITS


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of all passages, where each passage begins, and the text of each passage."""
    f, where, owner = hashed(texts)
    f, where = once(f, where)
    return f, np.searchsorted(where, np.arange(len(owner))), owner


class Ftrl:
    """FTRL-proximal logistic regression with per-coordinate rates (public algorithm of McMahan et al., 2013)."""

    def __init__(self) -> None:
        self.z = np.zeros(1 << BITS)
        self.n = np.zeros(1 << BITS)
        self.bias_z = self.bias_n = self.shift = 0.0

    def weights(self, f: np.ndarray | slice) -> np.ndarray:
        z = self.z[f]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[f])) / ALPHA + L2))

    def bias(self) -> float:
        return self.shift - self.bias_z / ((BETA + self.bias_n**0.5) / ALPHA + L2)

    def learn(self, f: np.ndarray, starts: np.ndarray, y: np.ndarray) -> None:
        """One step on a small batch of passages."""
        at, inv = np.unique(f, return_inverse=True)
        w, b = self.weights(at), self.bias()
        p = 1 / (1 + np.exp(-np.clip(np.add.reduceat(w[inv], starts) + b, -30, 30)))
        g = p - y
        each = np.repeat(g, np.diff(np.r_[starts, len(f)]))
        g1, g2 = np.bincount(inv, each, len(at)), np.bincount(inv, each * each, len(at))
        self.z[at] += g1 - (np.sqrt(self.n[at] + g2) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] += g2
        t = (g * g).sum()
        self.bias_z += g.sum() - ((self.bias_n + t) ** 0.5 - self.bias_n**0.5) / ALPHA * b
        self.bias_n += t


def passage_scores(w: np.ndarray, bias: float, f: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The log odds of each passage."""
    return np.add.reduceat(w[f], starts) + bias if len(starts) else np.empty(0)


def _fit_passages(bags: list[np.ndarray], label: np.ndarray, rng: np.random.Generator) -> Ftrl:
    model = Ftrl()
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            mine = order[at : at + BATCH]
            sizes = np.array([len(bags[k]) for k in mine])
            model.learn(np.concatenate([bags[k] for k in mine]), np.r_[0, np.cumsum(sizes)[:-1]], label[mine])
    return model


def fit(texts: list[str], y: np.ndarray) -> Ftrl:
    """A model for passages from ratings of whole texts (0 or 1).

    In every round each half of the texts is judged by a model of the other half, so a wrong rating can't vouch for
    itself. Of a positive text the passages that look worst explain the rating and its others count for neither class;
    a positive text without any such passage and a negative one that looks very bad are taken for wrong ratings.
    """
    f, starts, owner = features(texts)
    ends = np.r_[starts[1:], len(f)]
    bags = [f[a:e] for a, e in zip(starts, ends)]
    rng = np.random.default_rng(SEED)
    # equal texts go to one half
    half = (pd.util.hash_array(np.array(texts, dtype=object), categorize=False) % 2).astype(int) if texts else np.empty(0, int)
    pos = y[owner] == 1 if len(owner) else np.empty(0, bool)
    label, use = pos.astype(float), np.ones(len(owner), bool)

    def learned(which: np.ndarray) -> Ftrl:
        k = np.flatnonzero(use & which)
        return _fit_passages([bags[x] for x in k], label[k], rng)

    for r in range(ROUNDS if len(owner) else 0):
        s = np.empty(len(owner))
        for side in (0, 1):
            m = learned(half[owner] != side)
            mine = half[owner] == side
            s[mine] = passage_scores(m.weights(slice(None)), m.bias(), f, starts)[mine]
        top = np.full(len(texts), -np.inf)
        np.maximum.at(top, owner, s)
        t = top[owner]
        pick = pos & ((s >= 0) | (s >= t - 1e-9)) & (t > LEAST[min(r, len(LEAST) - 1)])
        label, use = pick.astype(float), pick | (~pos & (t < MOST))
    model = learned(np.ones(len(owner), bool))
    # few ratings give cautious scores: move the border to where hardly any text of the other half that is rated 0 lies
    calm = top[(y == 0) & (top < MOST)] if len(owner) and ROUNDS else np.empty(0)
    if len(calm):
        # (a passage of which nothing is known stays below it)
        model.shift = -float(np.clip(np.quantile(calm, 0.995) + MARGIN, min(max(FLOOR, model.bias() + MARGIN), 0.0), 0.0))
    return model


def _train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    b = pd.concat(list(batches), ignore_index=True).sort_values(["h", "doc_id"], kind="stable")
    model = fit(list(b["text"]), b["y"].to_numpy())
    w = model.weights(slice(None))
    at = np.flatnonzero(w)
    yield pd.DataFrame({"slot": np.r_[-1, at].astype(np.int64), "w": np.r_[model.bias(), w[at]]})


def training_rows(docs: DataFrame, labels: DataFrame, n: int = MAX_TRAINING_DOCS) -> DataFrame:
    """(doc_id, text, y, h): the first n rated documents in hash order, by majority of their ratings.

    Ties, documents without a rating and texts above MAX_TRAINING_CHARS_EACH are left out. Of an id with several texts
    the first in order counts. Only the ids travel, n at most; the texts of other documents stay where they are.
    """
    votes = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("toxic").alias("v")).where("v <> 0.5")
    chosen = votes.select("doc_id", (F.col("v") > 0.5).cast("int").alias("y"), F.xxhash64("doc_id", F.lit(SEED)).alias("h")).orderBy("h", "doc_id").limit(n)
    rated = docs.where(F.col("text").isNotNull() & (F.length("text") <= MAX_TRAINING_CHARS_EACH)).select("doc_id", "text")
    return rated.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y", "h").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """{"slot", "w", "bias"}: the sparse weights, at most 2^BITS of them. Without ratings of both kinds every score is 0."""
    rows = training_rows(docs, labels).select("doc_id", "text", "y", "h")
    got = rows.repartition(1).mapInPandas(_train, "slot long, w double").toPandas()
    bias = got.loc[got["slot"] < 0, "w"]
    got = got[got["slot"] >= 0]
    return {"slot": got["slot"].to_numpy(np.int64), "w": got["w"].to_numpy(np.float64), "bias": float(bias.iloc[0]) if len(bias) else -30.0}


def _score(model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        w = np.zeros(1 << BITS)
        w[m["slot"]] = m["w"]
        for b in batches:
            top = np.full(len(b), -np.inf)
            f, where, owner = hashed([t or "" for t in b["text"]])
            known = w[f] != 0  # nearly all features have no weight
            f, where = once(f[known], where[known])
            np.maximum.at(top, owner, np.bincount(where, w[f], len(owner)) + m["bias"])
            b = b.drop(columns="text")
            b["score"] = np.where(np.isinf(top), 0.0, np.round(1 / (1 + np.exp(-np.clip(top, -30, 30))), 6))
            yield b

    return run


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, source, score): the probability that a document's worst passage is abusive, hateful or explicit.

    Null, empty and blank texts score 0. Rows are neither merged nor dropped; a null id or source stays null. Whole
    texts are scored, whatever their length. An empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    return docs.select("doc_id", "source", "text").mapInPandas(_score(model), "doc_id long, source string, score double")


def source_rates(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (source, n_docs, n_flagged, rate): each document id counts once in a source."""
    one = scored.groupBy("source", "doc_id").agg(F.max("score").alias("score"))
    got = one.groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if(F.col("score") >= threshold).alias("n_flagged"))
    return got.withColumn("rate", F.col("n_flagged") / F.col("n_docs"))

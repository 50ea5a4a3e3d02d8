"""Near repeats with their places, block against block."""

import random

import numpy as np
import pytest

from grainmill.operators import ranked
from grainmill.plans import QUERIES


def shuffled(spark) -> int:
    """Bytes that all jobs of the session have written to shuffles."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(30_000)
    return sc.statusStore().executorList(False).head().totalShuffleWrite()


def some_sets(r: random.Random, n: int, low: int, high: int, v: int) -> list[set[int]]:
    base = [r.sample(range(v), r.randrange(low, high)) for _ in range(n // 3)]
    out = []
    for _ in range(n):
        b = list(r.choice(base))
        for _ in range(r.randrange(0, max(1, len(b) // 3))):
            b[r.randrange(len(b))] = r.randrange(v)
        out.append(set(b[: r.randrange(1, len(b) + 1)] if r.random() < 0.3 else b))
    return out


@pytest.mark.parametrize("low, high, v, short, wide", [(1, 12, 30, 16, 512), (10, 60, 150, 16, 512), (5, 70, 90, 16, 40), (1, 40, 60, 3, 20)])
def test_block_pairs_equal_brute_force(monkeypatch, low, high, v, short, wide):
    for name, x in {"SHORT": short, "WIDE": wide, "BATCH": 17, "CHUNK": 600}.items():
        monkeypatch.setattr(ranked, name, x)
    r = random.Random(low)
    first, second = some_sets(r, 90, low, high, v), some_sets(r, 100, low, high, v)
    second[:15] = first[:15]
    code = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, v)
    packed = lambda s: (code[[w for x in s for w in sorted(x)]], np.array([len(x) for x in s]))
    for other in (None, second):
        got = [tuple(x) for x in ranked.block_pairs(packed(first), other and packed(other)).tolist()]
        near = ((i, j, len(x & y), min(len(x), len(y))) for i, x in enumerate(first) for j, y in enumerate(other or first) if other or i < j)
        assert got == [x for x in near if 4 * x[2] >= 3 * x[3]] and got


def test_ranked_pairs_are_right_and_shuffle_no_texts(spark, tmp_path):
    r = random.Random(5)
    told = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(3000)]
    ts = [" ".join(["Tab", "b", "c", *r.sample(told, 25)]) for _ in range(150)] + [f"tab B c {w}" for w in told[:100]]
    ts += [" ".join([*x.split()[:20], "end"]) for x in ts[:20]] + ["", " ", None, "\t", ts[0]]
    rows = [(i, "p", i, t) for i, t in enumerate(ts)]
    spark.createDataFrame(rows, "answer_id long, path string, line_no int, a string").write.parquet(f"{tmp_path}/answers.parquet")
    before = shuffled(spark)
    got = [tuple(x) for x in QUERIES["near_duplicates_ranked"](spark, str(tmp_path)).select("place", "a", "b", "similarity").collect()]
    used = shuffled(spark) - before
    sets = {t: set(t.lower().split()) for t in ts if t and t.split()}
    near = [(a, b, len(sets[a] & sets[b]), min(len(sets[a]), len(sets[b]))) for a in sets for b in sets if a < b]
    want = sorted(((k / m, a, b) for a, b, k, m in near if 4 * k >= 3 * m), reverse=True)
    assert sorted(got) == [(p, a, b, s) for p, (s, a, b) in enumerate(want, 1)] and len(want) > 15_000
    # 0.04 MB of texts; the texts of the pairs are 4 MB
    assert used < 300_000, used


def test_no_text_has_no_pairs(spark):
    none = spark.createDataFrame([(None,), ("",), (" ",)], "a string")
    assert ranked.ranked_near_pairs(none).count() == 0

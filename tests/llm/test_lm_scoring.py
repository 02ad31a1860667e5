from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from leafmill.llm import lm_scoring as L


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), ""]


def check(df, **how):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = [
        (i, held(i), len(ws), sum(c[w] > 0 for w in ws), n,
         sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        for i, t in rows for ws in [tokens(t)]
    ]
    got = L.lm_scores(df, **how).collect()
    names = ("id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    key = lambda x: (str(x[0]), x[2], x[3])
    for g, w in zip(sorted([tuple(r[k] for k in names) for r in got], key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9)
    return got


@pytest.mark.parametrize("hot", [0, 5, 1 << 18])
def test_base_score_is_exact_however_words_travel(spark, edge, hot):
    got = check(edge, hot=hot)
    assert all(r["score"] <= 0 for r in got)


def test_no_rows_and_nothing_to_learn_from(spark, edge, empty):
    assert L.lm_scores(empty).count() == 0
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    check(spark.createDataFrame([(i, "only held out") for i in held], "doc_id long, text string"))


def test_counts_come_back_from_the_filter(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(words, 200, p=(p := 1 / np.arange(1, 301)) / p.sum())) for _ in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(6)
    f = L.build_filter(df, 8000, 1 << 31)
    c = Counter(w for t in texts for w in tokens(t))
    keys = list(c)
    h = L.mix(np.array([np.frombuffer(__import__("xxhash").xxh3_128_digest(k.encode()), "<u8")[0] for k in keys]))
    got = f.counts(h)
    for k, n in zip(keys, got, strict=True):  # of the true level, or (rarely) above: never below
        assert n >= (3 * 2 ** math.floor(math.log2(c[k])) - 1) / 2
    exact = sum(n == (3 * 2 ** math.floor(math.log2(c[k])) - 1) / 2 for k, n in zip(keys, got, strict=True))
    assert exact > 0.97 * len(keys)
    fresh = L.mix(np.arange(20_000, dtype=np.uint64) + np.uint64(1 << 40))
    assert (f.counts(fresh) > 0).mean() < 0.02


def test_pairs_are_learnt(spark, prose):
    order = [f"t{k}" for k in range(30)]
    rows = [(i, " ".join(order[(i + k) % 30] for k in range(60))) for i in range(100)]
    got = {r["id"]: r for r in L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    held = [r for r in got.values() if r["held_out"]]
    assert held and all(r["score"] > r["base_score"] / 2 for r in held)


def test_the_filter_grows_beyond_what_is_broadcast(spark, edge, prose, monkeypatch):
    monkeypatch.setattr(L, "LEAST_BITS", 1 << 10)
    rows = [(i, " ".join(f"{w}{prose.rng.integers(0, 40)}" for w in prose(150).split())) for i in range(120)]
    df = edge.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string")).repartition(4)
    key = lambda r: (str(r["id"]), r["n_tokens"], r["base_score"])
    whole = sorted(L.lm_scores(df).collect(), key=key)
    cut = sorted(check(df, max_bits=1 << 15), key=key)
    assert [r["id"] for r in whole] == [r["id"] for r in cut]
    assert all(math.isclose(a["score"], b["score"], rel_tol=1e-9) for a, b in zip(whole, cut, strict=True))


def test_bits_a_token_are_the_same_at_every_size():
    for tokens in (10**7, 10**9, 5 * 10**9, 10**12):
        at = L.Layout(tokens, 1 << 31, 200)
        assert 4 <= at.bits / tokens < 8 and at.bits // at.segments <= 1 << 31 and at.each * at.segments == at.shards

from __future__ import annotations

import math
import zlib
from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from leafmill.llm import toxicity as T


def maximal(scores):
    """Ruzzo and Tompa's definition, by brute force: best first, then left and right of it."""
    spans = [(sum(scores[a:b]), a, b) for a, b in combinations(range(len(scores) + 1), 2)]
    best = max(spans, key=lambda x: (x[0], -(x[2] - x[1]), -x[1]), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    _, a, b = best
    left, right = maximal(scores[:a]), maximal(scores[b:])
    return left + [(a, b)] + [(x + b, y + b) for x, y in right]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-6, 6), max_size=14))
def test_segments_by_their_definition(whole):
    # powers of two apart, so that no two segments tie
    scores = [x + 2.0**-k / 64 for k, x in enumerate(whole, 1) if x]
    through = np.cumsum(scores)
    at = [i for i, s in enumerate(scores) if s > 0]
    got = T.maximal_segments(at, [through[i] - scores[i] for i in at], [through[i] for i in at])
    assert [(a, b) for a, b, _ in got] == maximal(scores)
    assert all(math.isclose(s, sum(scores[a:b]), abs_tol=1e-9) for a, b, s in got)


def table(spark, prose, n=600):
    bad = ["vilest", "rottenly", "badword", "grimmer"]
    rows, labels = [], []
    for i in range(n):
        words = prose(120).split(" ")
        if i % 6 == 0:
            for k in (20, 25, 31):
                words[k] = bad[(i // 6 + k) % 4].upper() + ("," if k == 25 else "")
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 6 == 0)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame([*labels, (None, 1), (3, None), (1, 0)], "doc_id long, toxic int"),
        dict(rows),
    )


def test_held_out_texts_and_their_passages(spark, prose):
    docs, labels, texts = table(spark, prose)
    got = T.toxicity(docs, labels).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in got if r["held_out"]]
    right = sum(r["predicted"] == int(r["id"] % 6 == 0) for r in held)
    assert right >= 0.98 * len(held)
    for r in held:
        if r["id"] % 6 == 0 and r["passages"]:
            p = r["passages"][0]
            inside = texts[r["id"]][p["start"] : p["end"]]
            assert any(w in inside.lower() for w in ("vilest", "rottenly", "badword", "grimmer"))


def test_edges(spark, edge, empty, no_labels, prose):
    docs, labels, _ = table(spark, prose, 120)
    got = T.toxicity(edge, no_labels).collect()
    assert len(got) == edge.count() and all(r["score"] == 0 and r["passages"] == [] for r in got)
    more = edge.select("doc_id", "text").unionByName(docs)
    scored = T.toxicity(more, labels).collect()
    assert len(scored) == more.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert T.toxicity(empty, labels).count() == 0


def test_extreme_value_law():
    lam = T.karlin_lambda(np.array([-1.0, 2.0]), np.array([0.8, 0.2]))
    assert math.isclose(0.8 * math.exp(-lam) + 0.2 * math.exp(2 * lam), 1, abs_tol=1e-9)
    rng = np.random.default_rng(2)
    n = rng.integers(50, 500, 4000).astype(float)
    best = (np.log(0.3 * n) + rng.gumbel(size=4000)) / 1.7
    assert 0.25 < T.fit_k(n, best, 1.7) < 0.36


def test_the_bound_is_on_texts_of_repeated_ids_too(spark, prose, monkeypatch):
    docs, labels, _ = table(spark, prose, 60)
    hot = spark.createDataFrame([(1, prose(30)) for _ in range(300)], "doc_id long, text string")
    seen = []
    fitted = T.logistic
    monkeypatch.setattr(T, "logistic", lambda x, y: seen.append(len(y)) or fitted(x, y))
    T.train(docs.union(hot).withColumnRenamed("doc_id", "id"), labels, rows=100)
    assert seen == [100]

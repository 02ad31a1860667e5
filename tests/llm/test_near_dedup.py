from __future__ import annotations

from collections import Counter

import numpy as np

from leafmill.llm import near_dedup as N
from leafmill.llm.linkage import ROUNDS, classes, components
from leafmill.scratch import settle


def grams(text, n=5):
    w = (text or "").encode().split()
    return Counter(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else Counter()


def jaccards(a, b):
    plain = len(a.keys() & b.keys()) / len(a.keys() | b.keys())
    weighted = sum(
        1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys()
    )
    return weighted, plain


def grouped(rows):
    """Classes by comparing all pairs."""
    shingles = [grams(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = shingles[i], shingles[j]
            if (not a and not b) or (a and b and max(jaccards(a, b)) >= 0.8):
                up[top(i)] = top(j)
    by = {}
    for i in range(len(rows)):
        by.setdefault(top(i), []).append(i)
    out = []
    for members in by.values():
        stays = min(((rows[i][0] is None, rows[i][0] or 0) for i in members))
        out += [(rows[i][0], None if stays[0] else stays[1], len(members)) for i in members]
    return sorted(out, key=str), len(by)


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want, n = grouped(rows)
    got = N.near_dedup(df).collect()
    assert sorted([(r["id"], r["class_id"], r["group_size"]) for r in got], key=str) == want
    assert sum(r["kept"] for r in got) == n


def test_edge_cases(spark, edge, empty):
    check(edge.where("length(text) < 50000 or text is null"))
    assert N.near_dedup(edge).count() == edge.count()
    assert N.near_dedup(empty).count() == 0


def test_families_as_all_pairs_would(spark, prose):
    rows = []
    for f in range(12):
        base = prose(90).split()
        for _ in range(int(prose.rng.integers(1, 40 if f == 0 else 7))):
            words = list(base)
            for _ in range(int(prose.rng.integers(0, 4))):
                words[int(prose.rng.integers(0, len(words)))] = "edited"
            if prose.rng.random() < 0.2:
                words += words[:30]
            rows.append((len(rows), " ".join(words)))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))


def test_registers_agree_by_probability_jaccard():
    rng = np.random.default_rng(0)
    x = rng.integers(1, 2**63, 60).astype(np.uint64)
    wa, wb = rng.integers(0, 4, 60).astype(float), rng.integers(0, 4, 60).astype(float)
    a, b = ({int(h): v for h, v in zip(x, w, strict=True) if v} for w in (wa, wb))
    want = jaccards(Counter(a), Counter(b))[0]
    text = np.repeat([0, 1], [len(a), len(b)])
    keys = np.array([*a, *b], np.uint64)
    held = N.prob_minhash(text, keys, np.array([*a.values(), *b.values()]), 2, 4000)
    assert abs((held[0] == held[1]).mean() - want) < 0.04
    pack = lambda d: (
        np.array(sorted(k >> 32 for k in d), "<u4").tobytes(), np.array([d[k] for k in sorted(d)], "<u4").tobytes()
    )
    got = N.similarity(*pack(a), *pack(b))
    assert np.allclose(got, jaccards(Counter(a), Counter(b)))


def test_sketches_rule_out_only_the_unlike(spark):
    rng = np.random.default_rng(6)
    held = rng.integers(1, 2**63, (2, 120)).astype(np.uint64)
    alike = held[0].copy()
    alike[:24] = rng.integers(1, 2**63, 24)  # four fifths agree
    rows = [(s.tolist(), t.tolist()) for s, t in ((N.sketches(held)[0], x) for x in N.sketches(np.stack([alike, held[1], held[0]])))]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    may = N.agree_enough(120, 0.8)
    assert [r[0] for r in df.select(may(df["a"], df["b"])).collect()] == [True, False, True]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (10, 20), (30, 20), (7, 8)] + [(100, k) for k in range(101, 160)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    label = {r["id"]: r["label"] for r in got}
    assert {label[k] for k in range(1, 7)} == {1} and {label[k] for k in (10, 20, 30)} == {10}
    assert {label[k] for k in range(100, 160)} == {100} and label[8] == 7


def test_one_bucket_of_unlike_members_loses_no_link(spark):
    # linked: numbers one apart, so that no leader is linked to more than two others
    members = settle(spark.range(40).selectExpr("1L AS bucket", "id * 2 + if(id >= 20, 1, 0) AS id"), "members")
    seen = []

    def verify(pairs, held):
        seen.append(pairs.count())
        return pairs.where("abs(a - b) <= 2")

    told = classes(members, lambda ids: ids.withColumn("sketch", ids["id"]), lambda a, b: a >= 0, verify)
    label = {r["id"]: r["label"] for r in told.collect()}
    assert {label[k] for k in range(0, 40, 2)} == {0}
    assert len(set(label.values())) == 1 or {label[k] for k in range(41, 80, 2)} == {41}
    assert sum(seen) <= 40 * 39 / 2


def test_leaders_unlike_all_others_lose_no_link(spark):
    ids = spark.range(20)
    leads = {min(ids.selectExpr(f"xxhash64(id, {turn}) AS h", "id").collect())["id"] for turn in range(ROUNDS)}
    pair = [k for k in range(20) if k not in leads][:2]
    members = settle(ids.selectExpr("1L AS bucket", "id"), "members")
    contents = lambda ids: ids.selectExpr("id", f"if(id IN ({pair[0]}, {pair[1]}), -1L, id) AS sketch")
    told = classes(members, contents, lambda a, b: a == b, lambda pairs, held: pairs.select("a", "b")).collect()
    assert {(r["id"], r["label"]) for r in told} == {(k, pair[0]) for k in pair}


def test_repeated_passages_are_found_by_plain_jaccard(spark):
    rows = []
    for f in range(8):
        words = [f"w{f}x{k}" for k in range(200)]
        for times in (0, 10, 25):  # the last 20 words so many times more
            rows.append((len(rows), " ".join(words + words[-20:] * times)))
        rows.append((len(rows), " ".join(words[:180] + words[:30] * 15)))
    assert jaccards(grams(rows[0][1]), grams(rows[1][1]))[0] < 0.6
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))

from __future__ import annotations

import re
from itertools import permutations

import numpy as np
import pytest

from leafmill.llm import filter_audit as A


def plain(docs, labels):
    """One loop over all documents for each order."""
    def fails(i, t):
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        return {
            "A": len(ws) < 50,
            "B": 100 * len(set(ws)) < 65 * len(ws),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": any((u or "") == t and j is not None and (i is None or j < i) for j, u, _ in docs),
        }

    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    rows = [(i, p or "", fails(i, t or "")) for i, t, p in docs]
    out = []
    for part in {p for _, p, _ in rows}:
        own = [(i, f) for i, p, f in rows if p == part]
        lost, removed_by = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[name]]
                left = [(i, f) for i, f in left if not f[name]]
                removed_by[name] += len(gone)
                failing = sum(f[name] for _, f in own)
                alone = sum(f[name] and sum(f.values()) == 1 for _, f in own)
                lost.append(
                    (part, "".join(order), step, len(left), len(gone), failing - len(gone), alone,
                     sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), name)
                )
        out += [(*r[:-1], removed_by[r[-1]]) for r in lost]
    return sorted(out)


def check(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = A.filter_audit(d, marks)
    assert got.columns == [x.split()[0] for x in A.STEPS.split(", ")]
    assert sorted(map(tuple, got.collect())) == plain(docs, labels)


def test_swaps_visit_every_order_once():
    for n in range(7):
        order, seen = list(range(n)), [tuple(range(n))]
        for k in A.adjacent_swaps(n):
            order[k], order[k + 1] = order[k + 1], order[k]
            seen.append(tuple(order))
        assert sorted(seen) == sorted(permutations(range(n)))


@pytest.mark.parametrize("seed", range(3))
def test_swaps_keep_the_counts(seed):
    rng = np.random.default_rng(seed)
    weights = {int(m): (int(rng.integers(1, 50)),) for m in rng.choice(32, 12, replace=False)}
    diagram = A.Diagram("ABCDE", weights, (0,))
    for level in A.adjacent_swaps(5):
        diagram.swap(level)
        for mask in range(32):
            at = diagram.root
            for name in diagram.order:
                at = (diagram.high if mask >> "ABCDE".index(name) & 1 else diagram.low)[at]
            assert diagram.weight[at] == weights.get(mask, (0,))
        assert diagram.weight[diagram.root][0] == sum(w[0] for w in weights.values())


def test_equal_nodes_are_one():
    diagram = A.Diagram("ABCDE", {}, (0,))
    assert [len(x) for x in diagram.levels] == [1] * 5


def test_documents(spark, prose):
    rng = prose.rng
    texts = []
    for _ in range(80):
        t = prose(int(rng.integers(1, 120)))
        t = " ".join(dict.fromkeys(t.split())) * int(rng.integers(1, 3)) if rng.random() < 0.5 else t
        t = t.upper() if rng.random() < 0.2 else t
        texts.append(t + str(rng.choice(["", "", "#", " $5", " |"])))
    docs = [(int(i), texts[int(rng.integers(0, 80))], str(rng.choice(["a", "b", "ç"]))) for i in rng.permutation(200)]
    labels = [(int(i), int(rng.integers(0, 2)), int(rng.integers(0, 2))) for i in rng.choice(260, 150, replace=False)]
    check(spark, docs, labels)


def test_edge_cases(spark, edge, empty, no_labels):
    rows = [(r["doc_id"], r["text"], None if i % 3 else "x") for i, r in enumerate(edge.collect())]
    rows += [(i, None if i % 2 else "", "y") for i in range(20, 24)] + [(None, "only here", "z"), (None, "only here", "")]
    labels = [(5, 1, 0), (5, 0, 1), (None, 1, 1), (1, None, None), (7, 1, None)]
    check(spark, rows, labels)
    check(spark, rows, [])
    assert A.filter_audit(empty.withColumnRenamed("label", "source"), no_labels).count() == 0


def test_clashing_columns(spark, no_labels):
    df = spark.createDataFrame([(1, "a b", "p"), (2, "a b", "p")], "doc_id long, text string, source string")
    want = sorted(map(tuple, A.filter_audit(df, no_labels).collect()))
    for name in ("id", "part", "mask", "sha", "size", "least", "i", "t", "rid", "n", "good"):
        df = df.withColumn(name, df["doc_id"])
    assert sorted(map(tuple, A.filter_audit(df, no_labels).collect())) == want

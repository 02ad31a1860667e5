from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from leafmill.llm import vector_codes as V


def plain(rows, parts, entries, rounds, scale):
    """Lists and loops: (id, code, error, label) of kept rows of the common length, and the codebooks."""
    kept = [
        (i, [math.floor(Fraction(x) * scale) for x in v], label)
        for i, v, label in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or []))
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = len(kept[0][1]) // parts
    cut = [[q[p * width : (p + 1) * width] for p in range(parts)] for _, q, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        moved = []
        for p in range(parts):
            own = [[] for _ in books[p]]
            for c in cut:
                own[nearest(p, c[p])[1]].append(c[p])
            moved.append(
                [[sum(xs) // len(o) for xs in zip(*o, strict=True)] if o else e for o, e in zip(own, books[p], strict=True)]
            )
        books = moved
    out = []
    for (i, _, label), c in zip(kept, cut, strict=True):
        found = [nearest(p, c[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    return out, books


def check(spark, rows, kind="array<float>", parts=2, entries=4, rounds=3, scale=64):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int").repartition(3)
    if kind == "array<float>":
        rows = [(i, v and [x and float(np.float32(x)) for x in v], label) for i, v, label in rows]
    got, books = V.vector_codes(df, parts=parts, entries=entries, rounds=rounds, scale=scale)
    want, plain_books = plain(rows, parts, entries, rounds, scale)
    assert [[list(map(int, e)) for e in b] for b in books] == plain_books
    by_label = {}
    for _, _, error, label in want:
        by_label[label] = by_label.get(label, 0) + error
    told = [(i, c, e, by_label[label]) for i, c, e, label in want]
    fits = lambda x: x if x < 1 << 63 else None
    told = [(i, c, fits(e), None if fits(e) is None else fits(s)) for i, c, e, s in told]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(told, key=str)


def test_gnat_finds_the_first_of_the_nearest():
    rng = np.random.default_rng(3)
    for n, d, top in ((1, 3, 5), (16, 8, 3), (40, 4, 2), (200, 6, 50), (64, 2, 1 << 29)):
        points = rng.integers(-top, top, (n, d))
        queries = rng.integers(-top, top, (500, d))
        index, best = V.Gnat(points).nearest(queries)
        gaps = ((queries[:, None] - points[None]) ** 2).sum(axis=2)
        assert (index == gaps.argmin(axis=1)).all()
        assert (best == gaps.min(axis=1)).all()


def test_gnat_leaves_subtrees_out(monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.integers(-10_000, 10_000, (8, 4))
    points = np.concatenate([c + rng.integers(-9, 9, (16, 4)) for c in centres])
    queries = points[rng.integers(0, len(points), 300)] + 1
    seen, squared = [], V.squared
    tree = V.Gnat(points)
    monkeypatch.setattr(V, "squared", lambda a, b: seen.append(len(a)) or squared(a, b))
    tree.nearest(queries)
    assert sum(seen) < 300 * len(points) / 3


def test_as_plain_loops(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=8).tolist(), int(i % 3) or None) for i in rng.permutation(120)]
    check(spark, rows)
    check(spark, rows, parts=4, entries=16, rounds=6, scale=4096)
    check(spark, [(i, [round(x) * 1.0 for x in v], label) for i, v, label in rows], scale=1)  # many ties


def test_dropped_null_repeated_and_huge(spark):
    rng = np.random.default_rng(6)
    rows = [(i % 20, rng.normal(size=4).tolist(), 1) for i in range(40)]
    rows += [(1, None, 1), (2, [1.0, None, 0.0, 0.0], 1), (3, [math.nan, 0.0, 0.0, 0.0], None), (4, [math.inf] * 4, 1)]
    rows += [(None, [0.5] * 4, None), (-1, [0.25] * 4, 2), (-1, [0.25] * 4, 2)]
    check(spark, rows)
    check(spark, [*rows, (77, [1e30, -1e30, 2.0, 3.0], 3), (78, [-3.4e38] * 4, 4), (79, [1e9] * 4, 5)])
    check(spark, [*rows, (80, [1e308, -1e308, 1.0, 1.0], 3)], kind="array<double>")


def test_fewer_vectors_than_entries(spark):
    check(spark, [(1, [1.0, 2.0], 1), (2, [3.0, -4.0], 1), (3, [3.0, -4.0], 2)], entries=16)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)]])
def test_nothing_to_code(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got, books = V.vector_codes(df)
    assert got.count() == 0 and books == []


def test_other_lengths_and_clashing_columns(spark):
    rows = [(1, [1.0, 2.0], "a"), (2, [3.0, 5.0, 6.0], "a"), (3, [], None), (4, [2.0, 2.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    for name in ("id", "key", "none", "code", "error", "size", "vector", "rid", "rid_file"):
        df = df.withColumn(name, df["vec_id"] * 0)
    got, books = V.vector_codes(df, parts=2)
    out = {r["id"]: (r["code"], r["error"]) for r in got.collect()}
    assert out[2] == (None, None) and out[3] == (None, None)
    assert out[1] == ("0000", 0) and out[4] == ("0100", 0)  # equal entries: the first of them


def test_large_sums_travel_in_limbs():
    for x in (0, 1, -1, 2**39, -(2**95) + 7, 10**40):
        assert sum(v << (V.LIMB_BITS * k) for k, v in V.limbs(x)) == x

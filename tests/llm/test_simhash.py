from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from leafmill.llm import simhash as S


def plain_print(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else ([" ".join(ws)] if ws else [])
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(fps, radius=3):
    """Index of the first of each one's component, by comparing all with all."""
    label = list(range(len(fps)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((top(i), top(j)))
                label[b] = a
    return [top(i) for i in range(len(fps))]


def near_prints(rng, n, flips, seeds=1):
    """n fingerprints made of few by turning over up to ``flips`` bits."""
    base = [int(x) for x in rng.integers(0, 2**63, seeds)]
    out = []
    for _ in range(n):
        x = base[int(rng.integers(0, seeds))]
        for b in rng.choice(64, int(rng.integers(0, flips + 1)), replace=False):
            x ^= 1 << int(b)
        out.append(x)
    return out


def same_classes(got, want):
    names = {}
    assert all(names.setdefault(g, w) == w for g, w in zip(got, want, strict=True))
    assert len(names) == len(set(want))


def test_fingerprints(edge, prose):
    rows = [r["text"] for r in edge.collect()] + [prose(k) for k in (1, 2, 3, 4, 50, 700)]
    rows += ["A b C d", "a B c D", "É b c", "é b c", "x y z w", "same same same same"]
    assert [S.fingerprint(t or "") for t in rows] == [plain_print(t) for t in rows]
    assert S.fingerprint("") == 0 == S.fingerprint(" \n")


def test_every_link_shares_a_first_and_a_second_bucket():
    rng = np.random.default_rng(1)
    for _ in range(2000):
        d = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(not d & m for m in S.FIRST)
        for m, own in zip(S.FIRST, S.SECOND, strict=True):
            assert d & m or any(not d & x for x in own)
    assert len(set(S.FIRST)) == 20 and all(len(set(own)) == 20 for own in S.SECOND)
    assert min(x.bit_count() for own in S.SECOND for x in own) >= 46


def test_counters_are_distances():
    rng = np.random.default_rng(2)
    fps = np.array(near_prints(rng, 200, 8), np.uint64)
    for s in (1, 7, 64):
        live = S.within(S.planes(fps[:-s]), S.planes(fps[s:]), S.padding(len(fps) - s))
        want = [k for k in range(len(fps) - s) if (int(fps[k]) ^ int(fps[k + s])).bit_count() <= 3]
        assert S.lanes_of(live).tolist() == want


def test_far_blocks_are_abandoned():
    fps = np.array([0, 2**64 - 1] * 64, np.uint64)
    a, b = S.planes(fps[0::2]), S.planes(fps[1::2])
    seen = []

    class Watched(list):
        def __getitem__(self, k):
            seen.append(k)
            return super().__getitem__(k)

    S.within(Watched(a), Watched(b), S.padding(64))
    assert max(seen) == 7


@pytest.mark.parametrize("n", [1, 2, 63, 65, 700, 5000])
def test_large_buckets(n):
    rng = np.random.default_rng(n)
    fps = sorted(set(near_prints(rng, n, 6, 3)))
    got = np.arange(len(fps))
    at, low = S.linked_in(np.array(fps, np.uint64))
    got[at] = low
    assert len(at) < len(fps)  # a forest, not pairs
    if n < 1000:
        same_classes(got.tolist(), plain_classes(fps))


@pytest.mark.parametrize("bucket", [S.BUCKET, 8])
def test_components_as_comparing_all(spark, monkeypatch, bucket):
    """Also where buckets are cut again."""
    rng = np.random.default_rng(9)
    fps = near_prints(rng, 500, 5, 12) + [int(x) for x in rng.integers(0, 2**63, 200)] + near_prints(rng, 200, 1) + [0, 1, 3, 7]
    fps = sorted({S.signed(x) for x in fps})
    links = S.links(spark.createDataFrame([(x,) for x in fps], "fp long").repartition(3), bucket).collect()
    place = {x: i for i, x in enumerate(fps)}
    label = list(range(len(fps)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for r in links:
        assert ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 64
        a, b = sorted((top(place[r["a"]]), top(place[r["b"]])))
        label[b] = a
    same_classes([top(i) for i in range(len(fps))], plain_classes([x & (2**64 - 1) for x in fps]))


def check(spark, df):
    rows = df.collect()
    fps = [plain_print(r["text"]) for r in rows]
    label = plain_classes(fps)
    least = {}
    for r, k in zip(rows, label, strict=True):
        ids = [x for x in (least.get(k), r["doc_id"]) if x is not None]
        least[k] = min(ids, default=None)
    want = Counter((r["doc_id"], f"{fp:016x}", least[k]) for r, fp, k in zip(rows, fps, label, strict=True))
    assert Counter(map(tuple, S.simhash_dedup(df).collect())) == want


def test_edge_cases(spark, edge, empty):
    check(spark, edge)
    assert S.simhash_dedup(empty).count() == 0


def test_documents(spark, prose):
    base = [prose(int(prose.rng.integers(1, 120))) for _ in range(60)]
    rows = [(1000 - i, base[i % 60] + (" tail" if i % 7 == 0 else "")) for i in range(300)]
    rows += [(2000 + i, "hot text of many rows") for i in range(300)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5))


def test_a_bucket_in_many_batches_is_whole():
    import pandas as pd

    rng = np.random.default_rng(11)
    fps = np.array(sorted(set(near_prints(rng, 300, 4))), np.uint64)
    frame = pd.DataFrame({"part": 1, "key": 5, "fp": fps.view(np.int64)})
    other = pd.DataFrame({"part": 2, "key": 5, "fp": fps.view(np.int64)[:3]})
    whole = pd.concat(S.links_of(iter([pd.concat([frame, other])])))
    cut = pd.concat(S.links_of(iter([frame[:100], frame[100:101], frame[101:], other])))
    assert sorted(map(tuple, cut.to_numpy())) == sorted(map(tuple, whole.to_numpy()))

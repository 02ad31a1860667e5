from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np
import pytest
from tokenizers import Tokenizer

from leafmill.llm import packing as P

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def fewest(items: tuple[int, ...], size: int) -> int:
    """The smallest number of bins, by trying all of them."""
    items = tuple(sorted(items, reverse=True))
    best = len(items)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for b in {v: i for i, v in enumerate(bins) if v + items[k] <= size}.values():
            place(k + 1, [v + items[k] * (i == b) for i, v in enumerate(bins)])
        place(k + 1, [*bins, items[k]])

    place(0, [])
    return best


def test_reduction_loses_no_sequence():
    rng = np.random.default_rng(3)
    for _ in range(300):
        size = int(rng.integers(6, 40))
        items = rng.integers(1, size + 1, int(rng.integers(1, 10)))
        n = np.bincount(items, minlength=size + 1)
        left = n.copy()
        fixed = P.reduce(left, size)
        rest = tuple(np.repeat(np.arange(size + 1), left).tolist())
        assert sum(m for m, _ in fixed) + fewest(rest, size) == fewest(tuple(items.tolist()), size)
        for m, held in fixed + P.best_fit(left.copy(), size):
            assert m > 0 and sum(v * c for v, c in held) <= size
            for v, c in held:
                n[v] -= m * c
        assert not n.any()


def test_best_pair():
    rng = np.random.default_rng(4)
    for _ in range(200):
        items = rng.integers(1, 20, int(rng.integers(1, 7)))
        room = int(rng.integers(1, 40))
        n = np.bincount(items, minlength=64)
        sums = [a + b for a, b in combinations(items.tolist(), 2) if a + b <= room]
        got = P.best_pair(n, room)
        assert (got is None and not sums) or sum(got) == max(sums)


@pytest.mark.parametrize("size", [2048, 32])
def test_pieces_are_whole_and_sequences_gapless(spark, edge, empty, size):
    library = Tokenizer.from_file(PATH)
    got = P.pack(edge, PATH, size=size, with_ids=True).toPandas()
    want = []
    for r in edge.collect():
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        for k, s in enumerate(range(0, len(ids), size)):
            want.append((str(r["doc_id"]), k, s, len(ids[s : s + size]), zlib.crc32(ids[s : s + size].tobytes())))
    ids = [None if np.isnan(x) else int(x) for x in got["id"]]
    rows = zip(map(str, ids), got["piece"], got["start"], got["length"], got["ids_crc32"], strict=True)
    assert sorted(rows) == sorted(want)
    assert all(zlib.crc32(np.array(x, "<u4").tobytes()) == c for x, c in zip(got["ids"], got["ids_crc32"], strict=True))
    got = got.sort_values(["sequence_id", "offset"])
    filled = got.groupby("sequence_id")["length"]
    assert (filled.sum() <= size).all() and (filled.cumsum() - got["length"] == got["offset"]).all()
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // size) + 2
    assert P.pack(empty, PATH).count() == 0

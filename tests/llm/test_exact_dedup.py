from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from leafmill.llm import exact_dedup as E


def plain(rows):
    groups = defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, k, i))
    out = []
    for bare, members in groups.items():
        stays = min(members)
        sha = hashlib.sha256(bare.encode()).hexdigest()
        out += [(m[4], stays[4], len(members), sha) for m in members]
    return sorted(out, key=str), len(groups)


def check(spark, df, **how):
    got = E.exact_dedup(df, **how).collect()
    want, groups = plain([(r["doc_id"], r["text"]) for r in df.collect()])
    assert sorted([(r["id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=str) == want
    assert sum(r["kept"] for r in got) == groups
    assert all(r["id"] == r["keep_id"] for r in got if r["kept"])


def test_edge_cases(spark, edge, empty):
    check(spark, edge)
    assert E.exact_dedup(empty).count() == 0


@pytest.mark.parametrize("how", [{}, {"bits_per_row": 1}, {"max_filter_bytes": 64}])
def test_as_one_dictionary_would(spark, prose, how):
    texts = [prose(int(prose.rng.integers(1, 9))) for _ in range(300)]
    rows = [(i, texts[int(prose.rng.integers(0, 300))] + " " * (i % 3)) for i in range(600)]
    rows += [(1000 + i, "hot text") for i in range(400)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5), **how)


def test_single_rows_stay_out_of_the_shuffle(spark, prose):
    rows = [(i, f"{i} {prose(5)}") for i in range(2000)] + [(9000, "7 dup"), (9001, "7 dup")]
    prints = E.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    bits = E.repeated_filter(prints, 1 << 15)
    maybe = E.may_repeat(prints, bits, 1 << 15).where("maybe").collect()
    assert {9000, 9001} <= {r["id"] for r in maybe}
    assert len(maybe) < 200

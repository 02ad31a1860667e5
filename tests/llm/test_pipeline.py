from __future__ import annotations

import corpus_pipeline as C
import pytest

from leafmill.llm import near_dedup, quality_rules, queries, secret_scan

pytest.importorskip("public_tokenizers")


def test_stages_one_by_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    results = {}
    for name, stage in C.STAGES:
        results[name] = (docs, C.settle(stage(spark, docs, sf), name))
        docs = results[name][1]
        if name != "packing":
            assert docs.columns == columns
    given, good = results["quality_rules"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = {r["id"]: r["kept"] for r in quality_rules.quality_rules(given, labels).collect()}
    assert {r["doc_id"] for r in good.collect()} == {i for i, k in judged.items() if k}

    given, one = results["exact_dedup"]
    bare = lambda r: "".join((r["text"] or "").encode().decode().translate({k: None for k in (32, *range(9, 14))}))
    assert len({bare(r) for r in given.collect()}) == one.count() == len({bare(r) for r in one.collect()})

    given, apart = results["near_dedup"]
    kept = {r["id"] for r in near_dedup.near_dedup(given).collect() if r["kept"]}
    assert {r["doc_id"] for r in apart.collect()} == kept

    given, masked = results["secret_scan"]
    before = {r["doc_id"]: r for r in given.collect()}
    for r in masked.collect():
        assert not secret_scan.base_spans(r["text"])
        assert r["text"] == before[r["doc_id"]]["text"] or "<secret>" in r["text"]
    given, packed = results["packing"]
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(before)
    rows = packed.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert all(r[1] <= 2048 for r in rows)


def test_rows_with_nulls_and_clashing_columns(spark, edge, sf):
    docs = edge
    for name, stage in C.STAGES[:4]:
        docs = C.settle(stage(spark, docs, sf), name)
        assert docs.columns == edge.columns
        docs = C.settle(docs.unionByName(edge), "more")  # what a stage drops comes to the next one too
    assert C.STAGES[4][1](spark, docs, sf).select("doc_id").distinct().count() > 8
    for _, stage in C.STAGES:
        assert stage(spark, edge.limit(0), sf).count() == 0


def test_queries_are_registered():
    assert {q.partition("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert len(queries.QUERIES) == 13 and set(queries.ORACLE) <= set(queries.QUERIES)

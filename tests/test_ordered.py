"""Segmented scans against plain loops, with a key that holds most rows."""

import random

import pytest
from pyspark.sql import functions as F

from leafmill.functions.ordered import number_rows, with_running
from leafmill.operators.normalize import assign_ids


def _rows(seed):
    rng = random.Random(seed)
    rows = []
    for key, n in (("hot", 60), ("a", 5), ("b", 1), ("c", 14)):
        positions = rng.sample(range(200), n)
        rows += [(key, p, rng.randint(0, 9), f"t{p}") for p in positions]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [1, 3, 7, 1 << 20])
def test_running_equals_loop(spark, width):
    rows = _rows(width)
    df = spark.createDataFrame(rows, "k string, ord bigint, v bigint, t string").repartition(3)
    got = with_running(
        df,
        ["k"],
        "ord",
        sums={"s": F.col("v")},
        maxes={
            "m": F.when(F.col("v") > 5, F.col("ord")),
            "l": F.when(F.col("v") > 5, F.struct("ord", "t")),
        },
        width=width,
    ).collect()
    want = {}
    for key in {r[0] for r in rows}:
        total, newest = 0, None
        for _, p, v, t in sorted(r for r in rows if r[0] == key):
            total += v
            if v > 5:
                newest = (p, t)
            want[key, p] = (total, newest and newest[0], newest)
    assert {
        (r.k, r.ord): (r.s, r.m, tuple(r.l) if r.l else None) for r in got
    } == want


@pytest.mark.parametrize("width", [2, 50])
def test_numbering(spark, width):
    rows = _rows(1)
    df = spark.createDataFrame(rows, "k string, ord bigint, v bigint, t string")
    got = {(r.k, r.ord): r.n for r in number_rows(df, ["k"], "ord", width=width).collect()}
    for key in {r[0] for r in rows}:
        for n, p in enumerate(sorted(r[1] for r in rows if r[0] == key), start=1):
            assert got[key, p] == n


def test_ids_widen_past_four_digits(spark):
    df = spark.range(9999, 10001).select(F.lit("d").alias("doc_id"), F.col("id").alias("ord"))
    got = [r.id for r in assign_ids(df, "fig", dense=True).orderBy("ord").collect()]
    assert got == ["fig_9999", "fig_10000"]
    again = assign_ids(df, "fig")
    assert [r.id for r in again.orderBy("ord").collect()] == ["fig_0001", "fig_0002"]


def test_sparse_positions_of_one_hot_key(spark):
    """Each row is a segment of its own; no window then holds the key's segments together."""
    step = 1 << 31
    df = spark.range(3000).selectExpr("1 AS k", f"id * {step} AS ord", "id AS v")
    got = with_running(df, ["k"], "ord", sums={"s": F.col("v")}, maxes={"m": F.col("v")}, width=1 << 10)
    rows = sorted((r.ord // step, r.s, r.m) for r in got.collect())
    assert rows == [(i, i * (i + 1) // 2, i) for i in range(3000)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") >= 3

from __future__ import annotations

import re

from leafmill.llm import line_dedup as D

WORD = re.compile(r"[^\x20\x09-\x0D]")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain(rows, tau=2, least=24):
    lines = sorted({x for _, t in rows for x in (t or "").split("\n") if WORD.search(x)})
    up = {x: x for x in lines}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in lines:
        for b in lines:
            if a < b and min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= tau and edits(a, b) <= tau:
                up[top(b)] = top(a)
    seen = [
        (i is None, i or 0, k, top(x))
        for i, t in rows for k, x in enumerate((t or "").split("\n")) if x in up
    ]
    first, n = {}, {}
    for none, i, k, c in seen:
        first[c] = min(first.get(c, (True, 1 << 62, 0)), (none, i, k))
        n[c] = n.get(c, 0) + 1
    return sorted((none, i, k, *first[c], n[c]) for none, i, k, c in seen), len(first)


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want, classes = plain(rows)
    got = D.line_dedup(df).collect()
    told = lambda i: (i is None, i or 0)
    assert sorted((*told(r["id"]), r["line_no"], *told(r["keep_id"]), r["keep_line"], r["group_size"]) for r in got) == want
    assert sum(r["kept"] for r in got) == classes


def test_edge_cases(spark, edge, empty):
    check(edge.where("length(text) < 50000 or text is null"))
    assert D.line_dedup(edge).where("line_no = 0").count() >= 9
    assert D.line_dedup(empty).count() == 0


def test_edited_lines_as_all_pairs_would(spark, prose):
    rng = prose.rng
    rows = []
    for _ in range(14):
        base = prose(9).replace("\n", " ")[: int(rng.integers(10, 60))] + "é" * int(rng.integers(0, 3))
        for _ in range(int(rng.integers(1, 9))):
            x = list(base)
            for _ in range(int(rng.integers(0, 4))):
                k = int(rng.integers(0, len(x)))
                x[k : k + 1] = [["q"], [], [x[k], "z"]][int(rng.integers(0, 3))]
            rows.append((len(rows), "".join(x) + "\n\n" + base[:5] + "\n" + "".join(x)))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))


def test_texts_without_repeats(spark):
    long = "a line that is long enough to have an edit or two"
    df = spark.createDataFrame(
        [(1, f"{long}\nx\n\ny", "k"), (2, f"z\n{long}!\nx", "k"), (3, None, "k")], "doc_id long, text string, rid string"
    )
    got = {r["doc_id"]: r["text"] for r in D.without_repeats(df).collect()}
    assert got == {1: f"{long}\nx\n\ny", 2: "z", 3: None}
    clashing = df.withColumn("_drop", df["doc_id"]).withColumn("rid_file", df["doc_id"])
    told = D.without_repeats(clashing)
    assert told.columns == clashing.columns and {r["doc_id"]: r["text"] for r in told.collect()} == got


def test_stays_in_spark_functions(spark):
    df = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = D.line_dedup(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan

from __future__ import annotations

import re
from collections import Counter

from leafmill.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered), failed,
    )


def counts(rows):
    return sorted((str(r["id"]), *(r[c] for c in Q.COUNTS)) for r in rows)


def test_counts_and_edges(spark, edge, empty, no_labels, prose):
    got = Q.quality_rules(edge, no_labels).collect()
    assert counts(got) == sorted((str(r["doc_id"]), *plain(r["text"])) for r in edge.collect())
    assert all(r["llr"] == 0 and r["kept"] == (not r["base_failed"]) for r in got)
    assert Q.quality_rules(empty, no_labels).count() == 0
    rows = []
    for i in range(60):
        text = prose(int(prose.rng.integers(0, 120)))
        rows.append((i, text + ("|" * (i % 4)) + (text[: len(text) // 2] if i % 3 else "") + " a a a a a" * (i % 5)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert counts(Q.quality_rules(df, no_labels).collect()) == sorted((str(i), *plain(t)) for i, t in rows)


def test_foreign_words_go_and_clean_texts_stay(spark, prose):
    junk = lambda i: " ".join(f"{w}$$$" for w in prose(80).split())
    rows = [(i, junk(i) if i % 5 == 0 else prose(150)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, int(i % 5 != 0)) for i in range(0, 400, 2)] + [(1, 1), (1, 0), (None, 1), (3, None)],
        "doc_id long, quality int",
    )
    got = Q.quality_rules(df, labels).collect()
    judged = [r for r in got if not r["base_failed"]]
    assert len(judged) > 350
    assert all(r["kept"] == (r["id"] % 5 != 0) for r in judged)


def test_stays_in_spark_functions(spark, edge, no_labels):
    plan = Q.quality_rules(edge, no_labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan

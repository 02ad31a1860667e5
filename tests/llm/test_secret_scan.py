from __future__ import annotations

from itertools import product

import numpy as np

from leafmill.llm import secret_scan as S

KEY = "AKIA" + "Q7XZ" * 4


def test_patterns():
    text = f"Password = 'abc12' TOKEN:\"abcdef\" api_key=a/b+c=d {KEY} AKIAQ1 " + "0123456789abcdef" * 2 + " secret : zzzzzz"
    spans = S.base_spans(text)
    assert [(k, text[a:b]) for k, a, b in spans] == [
        ("assign", 'TOKEN:"abcdef'), ("assign", "api_key=a/b+c=d"), ("assign", "secret : zzzzzz"),
        ("access", KEY), ("hex", "0123456789abcdef" * 2),
    ]
    # the long s is no ASCII letter; a short value hides nothing that follows it
    assert S.base_spans("paſsword=abcdef") == [] and S.base_spans("token=abc token=abcdef")[0][1] == 10


def paths(score, steps):
    for tags in product(range(3), repeat=len(score)):
        seen = [0, *tags, 0]
        yield tags, sum(score[i, t] for i, t in enumerate(tags)) + sum(steps[a, b] for a, b in zip(seen, seen[1:], strict=False))


def test_chain_by_enumeration():
    rng = np.random.default_rng(1)
    size = np.array([3, 0, 1, 4, 2])
    begin = np.cumsum(size) - size
    score, steps = rng.normal(size=(10, 3)), rng.normal(size=(3, 3))
    tags = S.viterbi(score, begin, size, steps)
    p, used = S.marginals(score, begin, size, steps)
    total = np.zeros((3, 3))
    for b, n in zip(begin, size, strict=True):
        if not n:
            continue
        every = list(paths(score[b : b + n], steps))
        assert tuple(tags[b : b + n]) == max(every, key=lambda x: x[1])[0]
        w = np.exp([v for _, v in every])
        w /= w.sum()
        for k in range(n):
            for s in range(3):
                assert np.isclose(p[b + k, s], sum(x for x, (t, _) in zip(w, every, strict=True) if t[k] == s))
        for x, (t, _) in zip(w, every, strict=True):
            for i, j in zip([0, *t], [*t, 0], strict=True):
                total[i, j] += x
    assert np.allclose(used, total)


def texts(prose, n=80):
    rng = prose.rng
    hexes = lambda k: "".join(rng.choice(list("0123456789abcdef"), k))
    mixed = lambda k: "".join(rng.choice(list("abcdefXYZQRS0123456789"), k))
    return [
        prose(40) + (f' token = "{hexes(40)}" ' if i % 2 else f" password: {mixed(24)} ") + prose(20) if i % 4 else prose(60)
        for i in range(n)
    ]


def test_the_field_learns_and_adds(prose):
    rows = texts(prose)
    model = S.fit(rows)
    fresh = texts(prose)
    found = S.tagged(fresh, model)
    values = [S.value_spans(t) for t in fresh]
    hits = sum(any(a < e and s < b for _, a, b in f) for f, v in zip(found, values, strict=True) for s, e in v)
    assert hits >= 0.95 * sum(map(len, values))
    assert sum(len(f) for f, v in zip(found, values, strict=True) if not v) <= 1
    # a value after a name that no pattern has
    value = "Zq3fXbR0a9eYd2cS71fQ4bX8"
    odd = f"{prose(30)} passphrase: {value} {prose(10)}"
    assert any(odd[a:b] == value for k, a, b in S.find([odd], model)[0][3] if k == "crf")


def test_skipping_lines_changes_nothing(prose, monkeypatch):
    rows = texts(prose, 40)
    model = S.fit(rows)
    fast = S.tagged(rows, model)
    lines = S.Lines(rows)
    tags = S.viterbi(S.emissions(model, lines, rows), lines.begin, lines.size, model.steps)
    assert int((tags == S.B).sum()) == sum(map(len, fast))


def test_edges_and_redaction(spark, edge, empty, prose):
    got = S.secrets(edge).collect()
    assert len(got) == edge.count() and all(r["spans"] == [] for r in got)
    assert S.secrets(empty).count() == 0
    rows = [(i, t) for i, t in enumerate(texts(prose))] + [(None, f"x {KEY}"), (1000, None)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, spans int")
    held = sorted(S.secrets(df).collect(), key=lambda r: str(r["id"]))
    for r, (_, t) in zip(held, sorted(rows, key=lambda x: str(x[0])), strict=True):
        base = sorted(S.base_spans(t or ""), key=lambda x: (x[1], S.KINDS.index(x[0])))
        assert [tuple(x) for x in r["spans"] if x["kind"] != "crf"] == base
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(b[0] == k for b in base) for k in S.KINDS[:3])
    clean = S.redacted(df)
    assert clean.columns == df.columns
    for r in clean.collect():
        assert r["text"] is None or not S.base_spans(r["text"])
    assert sum(r["text"] is None for r in clean.collect()) == 1


def test_rare_patterns_are_all_learnt_from(spark, prose, monkeypatch):
    hits = [t for t in texts(prose, 40) if S.value_spans(t)]
    hits[0] = "\n".join([prose(3000).replace("\n", " ")] * 3 + [hits[0]] + [prose(3000)])
    rows = list(enumerate(hits + [prose(15) for _ in range(3000)])) + [(5, hits[5])] * 50
    seen = []
    monkeypatch.setattr(S, "fit", lambda some: seen.extend(some))
    S.train(spark.createDataFrame(rows, "id long, text string").repartition(4), sample=40)
    learnt = [t for t in seen if S.value_spans(t)]
    assert len(learnt) == len(hits) and len(seen) == len(hits) + S.PLAIN
    assert max(map(len, seen)) <= S.EXCERPT and set(hits[1:]) <= set(learnt)


def test_excerpts_keep_whole_lines_around_values():
    text = "\n".join([*(f"line {k}" for k in range(2000)), f"key {KEY}", *(f"line {k}" for k in range(2000))])
    some = S.excerpt(text, 500)
    assert len(some) <= 500 and KEY in some and set(some.split("\n")) <= set(text.split("\n"))
    assert KEY in S.excerpt("x " * 5000 + KEY + " y" * 5000, 500) and S.excerpt("short", 500) == "short"

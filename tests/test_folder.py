import os

import pytest
from pyspark.sql import functions as F

from leafmill.plans import corpus
from leafmill.plans.folder import run_folder
from leafmill.sinks import runs
from leafmill.streaming import jobs

def now():
    return F.lit("2024-01-01")



def page(title, n):
    pictures = "".join(f'<img src="{title}{k}.png" width="60" height="60" alt="a plot">' for k in range(n))
    return f"<h1>{title}</h1><p>text of {title}</p><table><tr><th>h</th></tr><tr><td>{title}</td></tr></table>{pictures}"


def state(spark, out, name, *columns):
    return sorted(tuple(r) for r in runs.read_runs(spark, f"{out}/{name}").select(*columns).collect())


def test_only_what_changed_is_enriched(spark, tmp_path, monkeypatch):
    home, out = tmp_path / "in" / "my files", str(tmp_path / "out")
    (home / "sub").mkdir(parents=True)
    put = lambda name, text: (home / name).write_text(text, encoding="utf-8")
    put("a.html", page("a", 2))
    put("b.html", page("b", 1))
    put("c.html", page("c", 1))
    put("skipped.txt", "x")
    enriched = []
    real = corpus.enrich
    monkeypatch.setattr(corpus, "enrich", lambda docs, *a, **k: enriched.append(sorted(r.doc_id for r in docs.collect())) or real(docs, *a, **k))

    def go(run):
        changes = run_folder(spark, str(home), out, run, options=corpus.Options(max_figures=1), now=now())
        return {os.path.basename(r.path): r.change for r in changes.collect()}

    assert go(1) == {"a.html": "new", "b.html": "new", "c.html": "new"}
    assert state(spark, out, "blocks", "doc_id", "text") == [(f"{x}.html", f"text of {x} h {x}") for x in "abc"]
    assert state(spark, out, "orphans", "doc_id", "path") == [("a.html", "a1.png")]

    assert go(2) == {"a.html": "same", "b.html": "same", "c.html": "same"}
    assert len(enriched) == 1  # nothing to do

    put("b.html", page("bb", 0))
    os.utime(home / "c.html", (1, 1))
    (home / "a.html").unlink()
    put("d.html", page("d", 1))
    assert go(3) == {"a.html": "deleted", "b.html": "changed", "c.html": "touched", "d.html": "new"}
    assert enriched[1:] == [["b.html", "d.html"]]
    assert state(spark, out, "blocks", "doc_id", "text") == [(f"{x[0]}.html", f"text of {x} h {x}") for x in ("bb", "c", "d")]
    assert state(spark, out, "figures", "doc_id", "figure_id") == [("c.html", "fig_0001"), ("d.html", "fig_0001")]
    assert state(spark, out, "documents", "doc_id") == [("b.html",), ("c.html",), ("d.html",)]
    assert go(4) == {"b.html": "same", "c.html": "same", "d.html": "same"}


def test_a_run_that_died_is_done_again(spark, tmp_path, monkeypatch):
    home, out = tmp_path / "in", str(tmp_path / "out")
    home.mkdir()
    (home / "a.html").write_text(page("a", 1), encoding="utf-8")

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(corpus.rollup, "smoke_checks", dies)
        with pytest.raises(RuntimeError):
            run_folder(spark, str(home), out, 1, now=now())
    run_folder(spark, str(home), out, 1, now=now())
    assert state(spark, out, "figures", "doc_id", "figure_id") == [("a.html", "fig_0001")]


def test_no_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert run_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"), 1).count() == 0


def test_stream_of_documents_after_a_killed_batch(spark, tmp_path, monkeypatch):
    src, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    ddl = "doc_id string, text string"
    parts = [[("a", "FEATURES\nfirst text"), ("b", "b text")], [("c", "timing of c")], [("a", "FEATURES\nsecond, longer text")]]
    for rows in parts:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(src)

    def enrich(docs):
        lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
        items = lines.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("ord"), F.lit(1).alias("page"), "text", F.when(F.col("text") == "FEATURES", 1).alias("level"))
        figures = lines.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("ord"), F.lit(1).alias("page"), F.lit("i.png").alias("image_path"), F.lit(60).alias("width"), F.lit(60).alias("height"), F.col("text").alias("caption"))
        return corpus.enrich(docs.select("doc_id", F.lit("p").alias("path"), F.lit(1).alias("page_count")), items, None, figures, now=now())

    def go():
        stream = jobs.read_stream(spark, src, ddl, files_per_batch=1)
        jobs.corpus_stream(stream, checkpoint, out, enrich)

    real, calls = corpus.rollup.smoke_checks, []

    def dies_once(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(corpus.rollup, "smoke_checks", dies_once)
    with pytest.raises(Exception, match="lost"):
        go()
    go()
    assert len(calls) == 4
    newest = spark.createDataFrame([("a", "FEATURES\nsecond, longer text"), ("b", "b text"), ("c", "timing of c")], ddl)
    whole = str(tmp_path / "whole")
    corpus.write(enrich(newest), whole, 1)
    for name, columns in {"blocks": ["doc_id", "id", "text"], "figures": ["doc_id", "figure_id", "caption"], "rollup": ["doc_id", "total_figures"], "statuses": ["doc_id", "figure_id", "status"]}.items():
        assert state(spark, out, name, *columns) == state(spark, whole, name, *columns)

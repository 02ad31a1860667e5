import os

from pyspark.sql import functions as F

from leafmill.operators.export import from_records, to_records
from leafmill.plans.corpus import Home, Options, enrich, write
from leafmill.scratch import passing, settle
from leafmill.sinks.runs import has_runs, read_runs
from leafmill.streaming.jobs import corpus_stream, read_stream

TEXT = "A quiet picture of some grey surface under even light, nothing else"


def inputs(spark):
    docs = spark.createDataFrame([("a", "in/a.pdf", 3), ("b", "in/b.pdf", 1)], "doc_id string, path string, page_count int")
    items = spark.createDataFrame(
        [("a", 1, 1, "FEATURES", 1), ("a", 2, 1, "state machine description", None), ("a", 3, 2, "two", None), ("b", 1, 1, "text", None)],
        "doc_id string, ord bigint, page int, text string, level int",
    )
    tables = spark.createDataFrame([("a", 1, 2, ["h"], [["1"]])], "doc_id string, ord bigint, page int, header array<string>, rows array<array<string>>")
    figures = spark.createDataFrame(
        [("a", i, p, "a.png", 60, 60, "") for i, p in ((1, 1), (2, 2), (3, 3))],
        "doc_id string, ord bigint, page int, image_path string, width int, height int, caption string",
    )
    replies = spark.createDataFrame([("a", "fig_0001", f"{TEXT} logo"), ("a", "fig_0003", TEXT)], "doc_id string, figure_id string, response string")
    return docs, items, tables, figures, replies


def test_full_run(spark, tmp_path):
    c = enrich(*inputs(spark), options=Options(model="m"), now=F.lit("2024-01-01"))
    stats = {r.doc_id: (r.page_count, r.block_count, r.table_count, r.figure_count) for r in c.stats().collect()}
    assert stats == {"a": (3, 1, 1, 3), "b": (1, 1, 0, 0)}
    types = {r.figure_id: r.classification.type for r in c.figures.collect()}
    assert types == {"fig_0001": "logo", "fig_0002": "other", "fig_0003": "other"}
    assert c.audit().isEmpty()
    roll = {r.doc_id: r.percent_complete for r in c.rollup().collect()}
    assert roll == {"a": 66.7, "b": 0.0}
    assert c.rollup_global().where("is_global = 1").first().total_figures == 3

    path = str(tmp_path / "out")
    write(c, path, 1)
    assert read_runs(spark, f"{path}/report").count() == 3
    docs, items, tables, figures, replies = inputs(spark)
    only_a = [df.where("doc_id = 'a'") for df in (docs, items, tables, figures.where("page = 1"), replies)]
    write(enrich(*only_a, now=F.lit("2024-01-01")), path, 2)
    assert [r.figure_id for r in read_runs(spark, f"{path}/statuses").collect()] == ["fig_0001"]
    assert {r.doc_id for r in read_runs(spark, f"{path}/blocks").collect()} == {"a", "b"}


def test_large_tables_are_written_once(spark, tmp_path):
    """They are settled where the run stores them; a run that is committed already isn't touched by enrich."""
    path = str(tmp_path / "out")
    names = ("blocks", "tables", "statuses", "figures")
    c = enrich(*inputs(spark), now=F.lit("2024-01-01"), home=Home(path, 1))
    files = {n: sorted(getattr(c, n).inputFiles()) for n in names}
    assert all(f"{path}/{n}/rows/" in f for n, there in files.items() for f in there)
    assert not any(has_runs(spark, f"{path}/{n}") for n in names)
    write(c, path, 1)
    assert {n: sorted(read_runs(spark, f"{path}/{n}").inputFiles()) for n in names} == files
    assert all(f.endswith(".zstd.parquet") for there in files.values() for f in there)

    before = read_runs(spark, f"{path}/statuses")
    again = enrich(*inputs(spark), existing=before, now=F.lit("2024-01-02"), home=Home(path, 1))
    assert not again.placed
    write(again, path, 1)
    second = enrich(*inputs(spark), now=F.lit("2024-01-03"), home=Home(path, 2))
    write(second, path, 2)
    stamps = {str(r.processed_at) for r in read_runs(spark, f"{path}/statuses").collect()}
    assert stamps == {"2024-01-03 00:00:00"} and read_runs(spark, f"{path}/report").count() == 3


def test_switches(spark):
    c = enrich(*inputs(spark), options=Options(no_images=True, no_tables=True))
    assert c.tables is None and c.figures is None and c.statuses is None
    assert {r.doc_id: r.figure_count for r in c.stats().collect()} == {"a": 0, "b": 0}

    c = enrich(*inputs(spark), options=Options(pages="2-3", max_figures=2), now=F.lit("2024-01-01"))
    assert [r.figure_id for r in c.figures.collect()] == ["fig_0002"]
    assert {r.doc_id: (r.block_count, r.table_count, r.figure_count) for r in c.stats().collect()}["a"] == (0, 1, 1)


def test_existing_statuses_survive_unless_forced(spark):
    first = enrich(*inputs(spark), now=F.lit("2024-01-01"))
    done = first.statuses.withColumn("status", F.lit("resolved_external")).where("figure_id = 'fig_0002'")
    kept = enrich(*inputs(spark), existing=done, now=F.lit("2024-01-02"))
    assert kept.rollup().where("doc_id = 'a'").first().percent_complete == 100.0
    forced = enrich(*inputs(spark), existing=done, options=Options(force=True), now=F.lit("2024-01-02"))
    assert forced.rollup().where("doc_id = 'a'").first().percent_complete == 66.7


def files(top):
    return {os.path.join(d, f) for d, _, names in os.walk(top) for f in names}


def shuffle_files(spark):
    """Those of the running session, by the folders of its block manager."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for f in files(d) if os.path.basename(f).startswith("shuffle_")}


def test_a_run_leaves_only_what_it_stores(spark, tmp_path):
    """Its scratch tables and shuffle files are gone when it ends; they had stayed as long as the session."""
    root, out = spark.conf.get("spark.checkpoint.dir"), str(tmp_path / "out")
    before, shuffled = files(root), shuffle_files(spark)
    with passing(spark):
        write(enrich(*inputs(spark), now=F.lit("2024-01-01"), home=Home(out, 1)), out, 1)
    assert files(root) == before
    assert not shuffle_files(spark) - shuffled
    stored = from_records(read_runs(spark, f"{out}/documents"))
    assert {r.doc_id: (len(r.blocks), len(r.tables), len(r.figures)) for r in stored.collect()} == {"a": (1, 1, 3), "b": (1, 0, 0)}


def test_passing_restores_the_session(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    with passing(spark):
        kept = settle(spark.range(3), "outer")
        with passing(spark):
            gone, stays = settle(spark.range(4), "inner"), settle(spark.range(5), "inner", lasting=True)
            assert gone.count() == 4 and spark.conf.get(key) == "true"
        assert spark.conf.get(key) == "true" and (kept.count(), stays.count()) == (3, 5)
        there = [f.removeprefix("file://") for f in (*gone.inputFiles(), *kept.inputFiles(), *stays.inputFiles())]
    assert spark.conf.get(key) == was and not any(os.path.exists(f) for f in there)


def test_a_streamed_batch_leaves_only_what_it_stores(spark, tmp_path):
    docs, items, *_ = inputs(spark)
    docs.write.parquet(str(tmp_path / "in"))
    root = spark.conf.get("spark.checkpoint.dir")
    before, out = files(root), str(tmp_path / "out")
    stream = read_stream(spark, str(tmp_path / "in"), docs.schema)
    corpus_stream(stream, str(tmp_path / "checkpoint"), out, lambda batch, home: enrich(batch, items, home=home), homed=True)
    assert files(root) == before
    assert read_runs(spark, f"{out}/doc_stats").count() == 2 and read_runs(spark, f"{out}/blocks").count() == 2


def test_records_are_the_nested_documents(spark):
    """As JSON, in shares, every record comes back as it was, odd characters and nulls included."""
    docs, items, tables, figures, replies = inputs(spark)
    odd = 'q"uote \\ back\\slash \u2028 \x01 \U0001f600 é {"a": [1]}'
    more = spark.createDataFrame([("a", 9, 3, odd, None), (None, 1, 1, "nobody", None)], items.schema)
    docs = docs.unionByName(spark.createDataFrame([("c", None, 1), (None, "in/n.pdf", 1)], docs.schema))
    root = spark.conf.get("spark.checkpoint.dir")
    before = files(root)
    c = enrich(docs, items.unionByName(more), tables, figures, replies, now=F.lit("2024-01-01"))
    left = {os.path.relpath(f, root).split("-")[0] for f in files(root) - before}
    assert left == {"docs", "blocks", "tables", "statuses", "figures", "pictures"}
    want, records = settle(c.nested(), "nested"), settle(to_records(c.nested()), "records")
    back = from_records(records)
    assert back.schema.simpleString() == want.schema.simpleString().replace("page_count:int", "page_count:bigint")
    assert sorted(map(str, back.collect())) == sorted(map(str, want.collect())) and want.count() == 3
    assert any(odd in b.text for r in back.where("doc_id = 'a'").collect() for b in r.blocks)
    assert from_records(records, "blocks ARRAY<STRUCT<id: STRING>>").columns == ["doc_id", "part", "blocks"]
    shares = [settle(c.nested((k, 3)), "share") for k in range(3)]
    assert sorted(str(r) for s in shares for r in s.collect()) == sorted(map(str, want.collect()))


def test_page_parts_come_from_one_shuffle(spark):
    """The parts and what they are overlapped with were gathered twice."""
    from leafmill.operators.context import page_parts

    rows = [("a", i, 1 + i // 4, f"line {i}") for i in range(12)] + [("a", None, 1, "nowhere"), (None, 1, 1, "nobody")]
    blocks = settle(spark.createDataFrame(rows, "doc_id string, ord bigint, page int, text string"), "blocks")
    parts = page_parts(blocks, 6, width=2, chars=None)
    got = {(r.page, r.part): r.whole for r in parts.collect()}
    assert len(got) == 6 and got[1, 0] == "line 0 line 1 line " and got[3, 5] == "line 10 line 11 "
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan

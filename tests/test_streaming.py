from pyspark.sql import functions as F

from leafmill.functions import rules as R
from leafmill.operators import lifecycle, rollup
from leafmill.sinks import runs
from leafmill.streaming import jobs

DDL = "doc_id string, figure_id string, status string, processed_at timestamp, event_id bigint"


def put(spark, path, rows, mode="append"):
    df = spark.createDataFrame(rows, "doc_id string, figure_id string, status string, processed_at string, event_id bigint")
    df.withColumn("processed_at", F.col("processed_at").cast("timestamp")).coalesce(1).write.mode(mode).parquet(path)


def test_only_unseen_files_are_processed(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    put(spark, src, [("d", "f1", "a timing thing", "2024-01-01 00:00:00", 1)])

    def go():
        stream = jobs.read_stream(spark, src, spark.read.parquet(src).schema)
        jobs.run_to_table(R.classify(stream, F.col("status")), out, ck)
        return sorted((r.figure_id, r.classification.type) for r in spark.read.parquet(out).collect())

    assert go() == [("f1", "timing_diagram")]
    put(spark, src, [("d", "f2", "a plot", "2024-01-02 00:00:00", 2)])
    assert go() == [("f1", "timing_diagram"), ("f2", "plot")]
    assert go() == [("f1", "timing_diagram"), ("f2", "plot")]


def test_latest_status_over_batches(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    key, by = ("doc_id", "figure_id"), ["processed_at", "event_id"]
    batches = [
        [("d", "f1", "x", "2024-01-01 00:00:00", 1), ("d", "f2", "x", "2024-01-01 00:00:00", 2)],
        [("d", "f1", "y", "2024-01-03 00:00:00", 3), ("d", "f2", "old", "2023-01-01 00:00:00", 4)],
        [("d", "f1", "z", "2024-01-03 00:00:00", 5), ("e", "f1", "n", "2024-01-01 00:00:00", 6)],
    ]
    for batch in batches:
        put(spark, src, batch)
        stream = jobs.read_stream(spark, src, spark.read.parquet(src).schema)
        jobs.upsert_to_runs(jobs.latest_stream(stream, key, by), out, ck, key)
    got = sorted((r.doc_id, r.figure_id, r.status) for r in runs.read_runs(spark, out, key).collect())
    want = sorted((r.doc_id, r.figure_id, r.status) for r in lifecycle.latest(spark.read.parquet(src), key, by).collect())
    assert got == want == [("d", "f1", "z"), ("d", "f2", "x"), ("e", "f1", "n")]


def test_readers_see_few_of_many_batches(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    key, by = ("doc_id", "figure_id"), ["processed_at", "event_id"]
    for n in range(13):
        put(spark, src, [("d", f"f{n % 4}", f"s{n}", f"2024-01-{n + 1:02d} 00:00:00", n)])
    stream = jobs.read_stream(spark, src, spark.read.parquet(src).schema, files_per_batch=1)
    jobs.upsert_to_runs(jobs.latest_stream(stream, key, by), out, ck, key, fan=3)
    assert len(runs.committed(spark, out)) == 13 + 4 + 1
    live = runs.live_runs(spark, out)
    assert live == [(2, 8), (1, 11), (0, 12)]
    state = runs.read_runs(spark, out, key)
    assert sorted((r.figure_id, r.status) for r in state.collect()) == [("f0", "s12"), ("f1", "s9"), ("f2", "s10"), ("f3", "s11")]
    read = state.inputFiles()
    assert read and all(any(f"/level={a}/run={b:019d}/" in f for a, b in live) for f in read)


def test_late_rows_are_dropped_and_open_windows_wait(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))

    def go(rows):
        put(spark, src, rows)
        stream = jobs.read_stream(spark, src, spark.read.parquet(src).schema)
        jobs.run_to_table(jobs.rollup_stream(stream), out, ck)
        return sorted((str(r.window_start)[:10], r.total_figures) for r in spark.read.parquet(out).collect())

    assert go([("d", "f1", "resolved_local", "2024-01-01 10:00:00", 1), ("d", "f2", "needs_external", "2024-01-02 02:00:00", 2)]) == [("2024-01-01", 1)]
    late = [("d", "f3", "resolved_local", "2024-01-01 11:00:00", 3), ("d", "f4", "resolved_local", "2024-01-04 00:00:00", 4)]
    assert go(late) == [("2024-01-01", 1), ("2024-01-02", 1)]


def test_counts_are_whole_at_any_time(spark, tmp_path):
    """After every batch: the rollup of the newest statuses, by document and by day, late rows included."""
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    batches = [
        [("d", "f1", "needs_external", "2024-01-01 10:00:00", 1), ("d", "f2", "resolved_local", "2024-01-01 11:00:00", 2), ("e", "f1", "odd", "2024-01-01 00:00:00", 3)],
        [("d", "f1", "resolved_external", "2024-01-05 10:00:00", 4), ("d", "f1", "needs_external", "2024-01-04 00:00:00", 5), ("d", "f2", "needs_external", "2023-12-31 00:00:00", 6)],
        [("d", "f3", "needs_external", "2023-01-01 00:00:00", 7), ("d", "f1", None, "2024-01-05 10:00:00", 8), ("e", "f9", "resolved_local", None, 9), ("d", "f2", "resolved_local", "2024-01-01 11:00:00", 10)],
    ]
    for batch in batches:
        put(spark, src, batch)
        stream = jobs.read_stream(spark, src, spark.read.parquet(src).schema)
        jobs.run_to_table(jobs.status_changes(stream), out, ck)
        newest = lifecycle.latest(spark.read.parquet(src), ["doc_id", "figure_id"], ["processed_at", "event_id"])
        changes = spark.read.parquet(out)
        for by in (F.col("doc_id"), F.to_date("processed_at").alias("day")):
            want = rollup.with_summary(newest.groupBy(by).agg(*rollup.status_counts()))
            assert sorted(map(str, rollup.rollup_of_changes(changes, by).collect())) == sorted(map(str, want.collect()))


def test_state_of_changes_is_kept_by_groups(spark, tmp_path):
    """Far fewer state records, each a call of Python, than figures; keys come out exactly, null ones too."""
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    ids = F.when(F.col("id") != 7, F.col("id") + (1 << 53) + 1)
    rows = spark.range(2000).select(
        ids.alias("doc_id"), F.when(F.col("id") % 5 > 0, F.concat(F.lit('f"\\ü'), "id")).alias("figure_id"),
        F.when(F.col("id") % 3 > 0, "resolved_local").alias("status"),
        F.timestamp_micros(F.col("id")).alias("processed_at"), F.col("id").alias("event_id"),
    )
    for later in (0, 1):
        moved = rows.where(f"event_id % 4 >= {2 * later}").withColumn("event_id", F.col("event_id") + later)
        moved.write.mode("append").parquet(src)
        stream = jobs.read_stream(spark, src, rows.schema)
        changes = jobs.status_changes(stream, groups=16)
        query = changes.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
        query = query.trigger(availableNow=True).start()
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 16
    got = spark.read.parquet(out)
    assert got.groupBy("delta").count().orderBy("delta").collect() == [(-1, 1000), (1, 3000)]
    left = got.groupBy("doc_id", "figure_id", "status", "processed_at").agg(F.sum("delta").alias("n")).where("n != 0")
    want = rows.select("doc_id", "figure_id", "status", "processed_at", F.lit(1).cast("bigint").alias("n"))
    assert left.exceptAll(want).isEmpty() and want.exceptAll(left).isEmpty()


def test_dedupe(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    put(spark, src, [("d", "f1", "x", "2024-01-01 00:00:00", 1)] * 3 + [("d", "f2", "x", "2024-01-01 00:00:01", 2)])
    stream = jobs.read_stream(spark, src, spark.read.parquet(src).schema)
    jobs.run_to_table(jobs.dedupe_stream(stream, ["doc_id", "figure_id"]), out, ck)
    assert sorted(r.figure_id for r in spark.read.parquet(out).collect()) == ["f1", "f2"]

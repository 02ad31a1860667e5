import pytest
from pyspark.sql import functions as F

from leafmill import schemas as S
from leafmill.operators import describe, lifecycle, report, rollup, triage

FIG = "doc_id string, figure_id string, image_path string, width int, height int"
NEUTRAL = "A quiet picture of some grey surface under even light, nothing else"
CASES = {
    # figure: (image, w, h, response) -> (status, stage, class, confidence)
    "logo": (("a.png", 60, 60, f"{NEUTRAL} with a logo"), ("resolved_local", "local_llm", "logo", 0.7)),
    "plot": (("a.png", 60, 60, "graph with x-axis and more"), ("needs_external", "local_llm", "plot", 0.3)),
    "long": (("a.png", 60, 60, NEUTRAL), ("resolved_local", "local_llm", "other", 0.7)),
    "short": (("a.png", 60, 60, "A quiet picture"), ("needs_external", "local_llm", "other", 0.3)),
    "fifty": (("a.png", 60, 60, "z" * 50), ("needs_external", "local_llm", "other", 0.3)),
    "fifty1": (("a.png", 60, 60, "z" * 51), ("resolved_local", "local_llm", "other", 0.7)),
    "unk": (("a.png", 60, 60, "<unk><unk><s>"), ("needs_external", "local_llm_failed", "", 0.3)),
    "nine": (("a.png", 60, 60, "abcdefghi"), ("needs_external", "local_llm_failed", "", 0.3)),
    "ctrl": (("a.png", 60, 60, "abcdefghijkl" + "\x01" * 18 + "x"), ("needs_external", "local_llm_failed", "", 0.3)),
    "blank": (("a.png", 60, 60, "   "), ("needs_external", "", "", 0.3)),
    "null": (("a.png", 60, 60, None), ("needs_external", "", "", 0.3)),
    "missing": ((None, 60, 60, NEUTRAL), ("resolved_local", "skip", "", 0.0)),
    "noise": (("a.png", 10, 49, NEUTRAL), ("resolved_local", "skip", "noise", 1.0)),
    "edge": (("a.png", 20, 25, NEUTRAL), ("resolved_local", "local_llm", "other", 0.7)),
}


def inputs(spark):
    figures = spark.createDataFrame([("d", k, *v[0][:3]) for k, v in CASES.items()], FIG)
    responses = spark.createDataFrame([("d", k, v[0][3]) for k, v in CASES.items()], S.RESPONSE)
    return figures, responses


def run(spark, **kw):
    return triage.triage(*inputs(spark), now=F.lit("2024-01-01"), model="m", **kw)


def test_every_branch(spark):
    got = {r.figure_id: (r.status, r.stage, r.local_llm_classification, r.confidence) for r in run(spark).collect()}
    assert got == {k: v[1] for k, v in CASES.items()}


def test_texts_and_template(spark):
    rows = {r.figure_id: r for r in run(spark).collect()}
    assert rows["missing"].local_llm_description == "File not found"
    assert rows["noise"].local_llm_description == "Image too small to be meaningful (10x49)"
    assert rows["unk"].local_llm_description == "" and rows["unk"].needs_external
    assert rows["logo"].local_llm_provider == "ollama" and rows["logo"].local_llm_model == "m"
    assert tuple(run(spark).columns) == S.STATUS_COLUMNS
    blank = triage.new_status(inputs(spark)[0])
    assert tuple(blank.columns) == S.STATUS_COLUMNS and blank.first().status == "needs_external"


def test_existing_statuses(spark):
    old = run(spark).where("figure_id = 'plot'").withColumn("status", F.lit("resolved_external"))
    old = old.unionByName(old.withColumn("figure_id", F.lit("elsewhere")))
    kept = {r.figure_id: r.status for r in run(spark, existing=old).collect()}
    assert len(kept) == len(CASES) and kept["plot"] == "resolved_external"
    forced = {r.figure_id: r.status for r in run(spark, existing=old, force=True).collect()}
    assert forced["plot"] == "needs_external" and "elsewhere" not in forced


def figures_with(spark, rows):
    df = spark.createDataFrame(rows, "doc_id string, figure_id string, type string, confidence double")
    return triage.baseline_description(
        df.select(
            "doc_id",
            "figure_id",
            F.lit(1).alias("page"),
            F.lit("cap").alias("caption"),
            F.array().cast("array<string>").alias("tags"),
            F.concat("figure_id", F.lit(".png")).alias("image_path"),
            F.struct("type", "confidence", F.lit("rule").alias("rationale")).alias("classification"),
        )
    )


STATUS = "doc_id string, figure_id string, status string, stage string, local_llm_description string, local_llm_classification string, confidence double, image_path string"


def test_fold_makes_the_status_class_canonical(spark):
    figs = figures_with(spark, [("d", "fig_0001", "state_machine", 0.88), ("d", "fig_0002", "plot", 0.85)])
    st = spark.createDataFrame([("d", "fig_0001", "resolved_local", "local_llm", "A simple TI logo image.", "logo", 0.7, "p")], STATUS)
    rows = {r.figure_id: r for r in lifecycle.fold_statuses(figs, st).collect()}
    one = rows["fig_0001"]
    assert tuple(one.classification) == ("logo", 0.7, "local_llm classification")
    assert tuple(one.derived.description) == ("A simple TI logo image.", 0.7, "local_llm (logo)")
    two = rows["fig_0002"]
    assert tuple(two.classification) == ("plot", 0.85, "rule")
    assert tuple(two.derived.description) == ("Pending local LLM processing.", 0.0, "LLM recommended")
    entry = report.report_entries(lifecycle.fold_statuses(figs, st)).where("figure_id = 'fig_0001'").first()
    detail = rollup.rollup_detail(st).first()
    assert entry.classification.type == detail.classification == "logo"


def test_fold_branches(spark):
    figs = figures_with(spark, [("d", f"f{i}", "other", 0.4) for i in range(5)])
    st = spark.createDataFrame(
        [
            ("d", "f0", "resolved_local", "skip", None, "", 0.0, "p"),
            ("d", "f1", "resolved_local", "skip", "", "", 0.0, "p"),
            ("d", "f2", "resolved_local", "skip", "File not found", "", 0.0, "p"),
            ("d", "f3", "needs_external", "", "", "", 0.3, "p"),
            ("d", "f4", "needs_external", "", "", "plot", None, "p"),
        ],
        STATUS,
    )
    rows = {r.figure_id: r for r in lifecycle.fold_statuses(figs, st).collect()}
    text = {k: (r.derived.description.text, r.derived.description.notes) for k, r in rows.items()}
    assert text == {
        "f0": ("Skipped", "skipped"),
        "f1": ("", "skipped"),
        "f2": ("File not found", "local_llm"),
        "f3": ("Pending external LLM processing.", "needs_external"),
        "f4": ("Pending external LLM processing.", "needs_external"),
    }
    assert tuple(rows["f4"].classification) == ("plot", 0.0, "local_llm classification")


@pytest.mark.parametrize(
    "label,notes,want",
    [
        ("plot", "", ("LLM: convert plot to CSV", 0.8)),
        ("state_machine", "", ("LLM: convert diagram to ASCII/Mermaid", 0.8)),
        ("pinout", "needs_external", ("LLM: describe complex figure", 0.8)),
        ("other", "needs_external", ("LLM: describe image", 0.7)),
        ("other", "LLM recommended", ("LLM: describe image", 0.7)),
        ("other", "local_llm (other)", ("none", 0.6)),
    ],
)
def test_recommendation(spark, label, notes, want):
    row = spark.range(1).select(report.recommend_action(F.lit(label), F.lit(notes)).alias("a")).first()
    assert (row.a.action, row.a.confidence) == want
    if label == "pinout":
        assert row.a.reason == "pinout requires detailed external analysis"


def test_audit(spark):
    figs = figures_with(spark, [("d", "f1", "other", 0.4), ("d", "f2", "plot", 0.8), ("d", "f3", "icon", 0.4)])
    st = spark.createDataFrame(
        [
            ("d", "f1", "needs_external", "local_llm", "short text", "other", 0.3, "p"),
            ("d", "f2", "resolved_local", "local_llm", "x", "logo", 0.7, "p"),
            ("d", "f9", "resolved_local", "local_llm", "x", "logo", 0.7, "p"),
        ],
        STATUS,
    )
    unfolded = lifecycle.audit_consistency(report.report_entries(figs), st)
    assert {r.figure_id: r.issue for r in unfolded.collect()} == {"f1": "routing", "f2": "class", "f3": "missing", "f9": "missing"}
    folded = lifecycle.audit_consistency(report.report_entries(lifecycle.fold_statuses(figs, st)), st)
    assert {r.figure_id: r.issue for r in folded.collect()} == {"f1": "routing", "f3": "missing", "f9": "missing"}


def test_round_trip_to_completion(spark):
    statuses = run(spark)
    figures = inputs(spark)[0]
    none = spark.createDataFrame([], "doc_id string, figure_id string")
    queue = lifecycle.external_queue(figures, statuses, none)
    assert {r.figure_id for r in queue.collect()} == {k for k, v in CASES.items() if v[1][0] == "needs_external"}
    partly = lifecycle.external_queue(figures, statuses.where("figure_id <> 'logo'"), queue.where("figure_id = 'plot'"))
    assert {r.figure_id for r in partly.collect()} == ({r.figure_id for r in queue.collect()} | {"logo"}) - {"plot"}
    analysed = queue.select(
        "doc_id",
        "figure_id",
        F.to_variant_object(F.struct(F.lit(1).alias("x"))).alias("result"),
        F.lit(None).cast("string").alias("provider"),
        F.lit("big").alias("model"),
    )
    done = lifecycle.apply_external(statuses, analysed)
    total = rollup.rollup_global(done).where("is_global = 1").first()
    assert total.percent_complete == 100.0 and total.total_figures == len(CASES)
    row = done.where("figure_id = 'plot'").first()
    assert (row.external_llm_provider, row.external_llm_model, row.needs_external) == ("", "big", False)
    assert lifecycle.external_queue(figures, done, none).isEmpty()


def test_rollups(spark):
    assert rollup.rollup_global(run(spark).limit(0)).isEmpty()
    docs = spark.createDataFrame([("d",), ("empty",)], "doc_id string")
    odd = run(spark).where("figure_id in ('logo', 'plot')").withColumn(
        "status", F.when(F.col("figure_id") == "plot", "strange").otherwise(F.col("status"))
    )
    rows = {r.doc_id: r for r in rollup.rollup_by_document(odd, docs).collect()}
    assert (rows["d"].total_figures, rows["d"].fully_processed, rows["d"].percent_complete) == (2, 1, 50.0)
    assert (rows["empty"].total_figures, rows["empty"].percent_complete) == (0, 0.0)
    assert rollup.rollup_detail(odd).count() == 1


def test_smoke_checks(spark):
    docs = spark.createDataFrame([(c,) for c in "abcdef"], "doc_id string")
    stats = spark.createDataFrame(
        [("a", 1, 1, 0, 0), ("b", 1, 1, 0, 0), ("c", 1, 0, 0, 0), ("d", 1, 1, 0, 2), ("e", 1, 0, 3, 0), ("f", 1, 1, 1, 1)],
        "doc_id string, page_count int, block_count bigint, table_count bigint, figure_count bigint",
    )
    have = [(d, k) for d in "bcdef" for k in ("document", "index") if (d, k) != ("b", "index")] + [("f", "figure"), ("f", "table")]
    got = rollup.smoke_checks(docs, stats, spark.createDataFrame(have, "doc_id string, kind string"))
    assert {(r.doc_id, r.failure) for r in got.collect()} == {
        ("a", "missing document"),
        ("b", "missing index"),
        ("c", "empty extraction"),
        ("d", "figures missing image"),
        ("e", "tables missing markdown"),
    }


def test_describe_figures(spark):
    def load():
        def reply(prompt, images):
            if "bad" in images:
                raise RuntimeError("model")
            return [f" {prompt[:8]} {image} " if image else None for image in images]

        return reply

    df = spark.createDataFrame([("d", "a", "ok"), ("d", "b", "bad"), ("d", "c", "ok"), ("d", "e", None)], "doc_id string, figure_id string, image_path string").coalesce(1)
    got = describe.describe_figures(df, load).orderBy("figure_id").collect()
    assert [(r.response, r.error) for r in got] == [("Describe ok", None), ("", "RuntimeError: model"), ("Describe ok", None), ("", None)]
    assert [r.response for r in describe.describe_figures(df, load, batch_size=1).orderBy("figure_id").collect()] == [r.response for r in got]
    assert describe.describe_figures(df.limit(0), load).columns == [*df.columns, "response", "error"]


@pytest.mark.parametrize("n, bad", [(1, set()), (64, set()), (64, {13}), (64, {0, 63}), (5, {0, 1, 2, 3, 4})])
def test_failed_calls_are_halved(n, bad):
    calls = []

    def reply(prompt, images):
        calls.append(len(images))
        if bad & set(images):
            raise RuntimeError("model")
        return [str(i) for i in images]

    told = describe.answers(reply, "", list(range(n)))
    assert told == [("", "RuntimeError: model") if i in bad else (str(i), None) for i in range(n)]
    assert calls[0] == n and len(calls) <= 1 + 2 * len(bad) * (n - 1).bit_length()


def test_wrong_number_of_responses():
    told = describe.answers(lambda prompt, images: ["x"] if len(images) == 2 else ["y"] * len(images), "", [1, 2])
    assert told == [("y", None), ("y", None)]
    assert describe.answers(lambda prompt, images: [], "", [1]) == [("", "ValueError: 0 responses to 1 images")]


def test_reports(spark):
    docs = spark.createDataFrame([("d",), ("empty",)], "doc_id string")
    figs = figures_with(spark, [("d", "fig_0002", "plot", 0.85), ("d", "fig_10000", "other", 0.4), ("d", "fig_9999", "icon", 1.0)])
    entries = report.report_entries(figs)
    lines = report.report_markdown(entries, docs)
    text = {
        d: [r.line for r in lines.where(F.col("doc_id") == d).orderBy("section", "ord", "line_no").collect()]
        for d in ("d", "empty")
    }
    assert text["empty"] == ["# Manual Processing Report", "", "No figures requiring manual follow-up."]
    assert text["d"][:10] == [
        "# Manual Processing Report",
        "",
        "## fig_0002",
        "- page: 1",
        "- caption: cap",
        "- image_path: fig_0002.png",
        "- classification: plot (0.85)",
        "- recommended_manual_action: LLM: convert plot to CSV",
        "- reason: plot digitization requires semantic understanding",
        "",
    ]
    assert [x for x in text["d"] if x.startswith("## ")] == ["## fig_0002", "## fig_9999", "## fig_10000"]
    none = report.global_report_markdown(entries.limit(0))
    assert [r.line for r in none.orderBy("section", "line_no").collect()] == ["# Global Manual Processing Report", "", "- none"]
    some = report.global_report_markdown(entries)
    assert some.where("line = '- fig_0002: LLM: convert plot to CSV'").count() == 1
    assert some.where("line = '- none'").isEmpty()


def test_rollup_text(spark):
    st = spark.createDataFrame(
        [
            ("d", "fig_0001", "resolved_local", "", "a\n" + "b" * 200, "logo", 0.7, "p1"),
            ("d", "fig_0002", "needs_external", "", "", "plot", 0.3, "p2"),
            ("d", "fig_0003", "needs_external", "", "why", "plot", 0.3, "p3"),
        ],
        STATUS,
    )
    docs = spark.createDataFrame([("d",), ("none",)], "doc_id string")
    lines = report.rollup_markdown(st, docs, hint="Ask.")
    rows = lines.where("doc_id = 'd'").orderBy("section", "ord", "line_no").collect()
    assert [r.line for r in rows] == [
        "# Figure Processing Rollup",
        "",
        "**Total figures:** 3",
        "**Resolved locally:** 1",
        "**Resolved by external LLM:** 0",
        "**Pending external LLM:** 2",
        "**Completion:** 33.3%",
        "",
        "---",
        "",
        "## Resolved locally (1)",
        "",
        "- `fig_0001` [logo] a " + "b" * 78,
        "",
        "## Needs external LLM (2)",
        "",
        "Ask.",
        "",
        "- `fig_0002` [plot] → `p2`",
        "- `fig_0003` [plot] → `p3`",
        "  why",
        "",
    ]
    parts = report.markdown_parts(lines, width=2).where("doc_id = 'd'")
    whole = "\n".join(r.text for r in parts.orderBy("section", "part").collect())
    assert whole == "\n".join(r.line for r in rows)
    assert lines.where("doc_id = 'none'").count() == 10
    assert {r.part for r in parts.collect()} <= {-1, 0, 1}  # the opening, and as many as there are figures
    whole = report.rollup_markdown(st, docs, chars=None, display=None)
    assert "- `fig_0001` [logo] a " + "b" * 200 in {r.line for r in whole.collect()}
    assert rollup.rollup_detail(st, 3).where("figure_id = 'fig_0001'").first().description == "a\nb"

"""Follow-up report and the Markdown forms of report and rollup.

Markdown is produced as a table of lines keyed (doc_id, section, ord, line_no):
no document or corpus is ever gathered to render it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill import schemas as S
from leafmill.functions import text as T
from leafmill.functions.ordered import segment_of
from leafmill.operators.rollup import DESCRIPTION_MAX, DISPLAY_MAX, rollup_by_document, rollup_detail

# Recommended actions, reasons and confidences.
PLOT_ACTION = ("LLM: convert plot to CSV", "plot digitization requires semantic understanding", 0.8)
DIAGRAM_CLASSES = ("block_diagram", "state_machine", "timing_diagram")
DIAGRAM_ACTION = (
    "LLM: convert diagram to ASCII/Mermaid",
    "diagram interpretation is not reliable locally",
    0.8,
)
DETAIL_CLASSES = ("register_map", "pinout", "schematic", "table_image", "wiring_diagram")
DETAIL_ACTION = "LLM: describe complex figure"
DETAIL_REASON = " requires detailed external analysis"
IMAGE_ACTION = "LLM: describe image"
UNRESOLVED_REASON = "local LLM could not resolve this figure"
RECOMMENDED_REASON = "insufficient local text extraction"
NO_ACTION = ("none", "local extraction sufficient", 0.6)

# Headings and empty-list texts of the Markdown reports.
REPORT_TITLE = "# Manual Processing Report"
REPORT_EMPTY = "No figures requiring manual follow-up."
GLOBAL_TITLE = "# Global Manual Processing Report"
GLOBAL_EMPTY = "- none"
ROLLUP_TITLE = "# Figure Processing Rollup"
EXTERNAL_HINT = "Use the prompt template for external analysis."
ROLLUP_SECTIONS = (
    (1, S.RESOLVED_LOCAL, "Resolved locally", False),
    (2, S.NEEDS_EXTERNAL, "Needs external LLM", True),
    (3, S.RESOLVED_EXTERNAL, "Resolved by external LLM", False),
)
FIGURE_LINES = 2  # at most, in a list of the rollup


def _advice(action: Column | str, reason: Column | str, confidence: float) -> Column:
    def lit(x):
        return x if isinstance(x, Column) else F.lit(x)

    return F.struct(
        lit(action).alias("action"), lit(reason).alias("reason"), F.lit(confidence).alias("confidence")
    )


def recommend_action(label: Column, notes: Column) -> Column:
    """(action, reason, confidence) for a figure class and the notes of its description."""
    return (
        F.when(label == "plot", _advice(*PLOT_ACTION))
        .when(label.isin(*DIAGRAM_CLASSES), _advice(*DIAGRAM_ACTION))
        .when(
            label.isin(*DETAIL_CLASSES),
            _advice(DETAIL_ACTION, F.concat(label, F.lit(DETAIL_REASON)), 0.8),
        )
        .when(notes == S.NEEDS_EXTERNAL, _advice(IMAGE_ACTION, UNRESOLVED_REASON, 0.7))
        .when(notes == "LLM recommended", _advice(IMAGE_ACTION, RECOMMENDED_REASON, 0.7))
        .otherwise(_advice(*NO_ACTION))
    )


def report_entries(figures: DataFrame) -> DataFrame:
    """What the follow-up report says about each figure."""
    advice = recommend_action(F.col("classification.type"), F.col("derived.description.notes"))
    return figures.withColumn("__advice", advice).select(
        "doc_id",
        "figure_id",
        "page",
        "caption",
        "tags",
        "image_path",
        "classification",
        F.col("__advice.action").alias("recommended_manual_action"),
        F.col("__advice.reason").alias("reason"),
        F.col("__advice.confidence").alias("confidence"),
    )


def _lines(df: DataFrame, section: int, order: Column, lines: list[Column]) -> DataFrame:
    """Explode an array of lines; null lines are left out."""
    return df.select(
        "doc_id",
        F.lit(section).alias("section"),
        order.cast("bigint").alias("ord"),
        F.posexplode(F.filter(F.array(*lines), lambda x: x.isNotNull())).alias("line_no", "line"),
    )


def report_markdown(entries: DataFrame, docs: DataFrame) -> DataFrame:
    """Lines of each document's report; section 0 is the head, 1 the figures in order."""
    reported = entries.select("doc_id").distinct()
    empty = docs.select("doc_id").join(reported, "doc_id", "left_anti")
    head = _lines(docs, 0, F.lit(0), [F.lit(REPORT_TITLE), F.lit("")])
    nothing = _lines(empty, 1, F.lit(0), [F.lit(REPORT_EMPTY)])
    bullets = [
        ("page", F.col("page")),
        ("caption", F.col("caption")),
        ("image_path", F.col("image_path")),
        (
            "classification",
            F.format_string(
                "%s (%s)",
                F.col("classification.type"),
                F.col("classification.confidence").cast("string"),
            ),
        ),
        ("recommended_manual_action", F.col("recommended_manual_action")),
        ("reason", F.col("reason")),
    ]
    body = _lines(
        entries,
        1,
        T.ordinal_of("figure_id"),
        [F.concat(F.lit("## "), F.col("figure_id"))]
        + [F.concat(F.lit(f"- {name}: "), value.cast("string")) for name, value in bullets]
        + [F.lit("")],
    )
    return head.unionByName(nothing).unionByName(body)


def global_report_markdown(entries: DataFrame) -> DataFrame:
    """Lines of the corpus-wide list: one action per figure, in document and figure order."""
    spark = entries.sparkSession
    head = _lines(
        spark.range(1).select(F.lit(None).cast(entries.schema["doc_id"].dataType).alias("doc_id")),
        0,
        F.lit(0),
        [F.lit(GLOBAL_TITLE), F.lit("")],
    )
    nothing = _lines(
        entries.agg(F.count(F.lit(1)).alias("n"))
        .where("n = 0")
        .select(F.lit(None).cast(entries.schema["doc_id"].dataType).alias("doc_id")),
        1,
        F.lit(0),
        [F.lit(GLOBAL_EMPTY)],
    )
    body = _lines(
        entries,
        1,
        T.ordinal_of("figure_id"),
        [F.concat(F.lit("- "), F.col("figure_id"), F.lit(": "), F.col("recommended_manual_action"))],
    )
    return head.unionByName(nothing).unionByName(body)


def rollup_markdown(
    statuses: DataFrame,
    docs: DataFrame | None = None,
    hint: str = EXTERNAL_HINT,
    *,
    chars: int | None = DESCRIPTION_MAX,
    display: int | None = DISPLAY_MAX,
) -> DataFrame:
    """Lines of each document's rollup: head (0), then resolved locally (1), pending (2), external (3).

    A list ends with a blank line at its last figure.  Descriptions are cut after ``chars`` characters,
    then, on one line, after ``display``; None is no cut.
    """
    ordinal = T.ordinal_of("figure_id")
    lasts = [F.max(F.when(F.col("status") == s, ordinal)).alias(f"__last_{s}") for _, s, *_ in ROLLUP_SECTIONS]
    totals = rollup_by_document(statuses, docs, *lasts)

    def bold(name: str, column: str, unit: str = "") -> Column:
        return F.concat(F.lit(f"**{name}:** "), F.col(column).cast("string"), F.lit(unit))

    def stretch(
        section: int, order: Column, lines: list[Column], when: Column | None = None, first: int = 0
    ) -> Column:
        piece = F.struct(
            F.lit(section).alias("section"),
            order.cast("bigint").alias("ord"),
            F.lit(first).alias("first"),
            F.array(*lines).alias("lines"),
        )
        return piece if when is None else F.when(when, piece)

    head = stretch(
        0,
        F.lit(0),
        [
            F.lit(ROLLUP_TITLE),
            F.lit(""),
            bold("Total figures", "total_figures"),
            bold("Resolved locally", S.RESOLVED_LOCAL),
            bold("Resolved by external LLM", S.RESOLVED_EXTERNAL),
            bold("Pending external LLM", "pending_external"),
            bold("Completion", "percent_complete", "%"),
            F.lit(""),
            F.lit("---"),
            F.lit(""),
        ],
    )
    frame = [head]
    for section, status, title, extra in ROLLUP_SECTIONS:
        opening = [
            F.concat(F.lit(f"## {title} ("), F.col(status).cast("string"), F.lit(")")),
            F.lit(""),
        ]
        if extra:
            opening += [F.lit(hint), F.lit("")]
        some = F.col(status) > 0
        frame.append(stretch(section, F.lit(-1), opening, some))
        last = F.coalesce(f"__last_{status}", F.lit(0))
        frame.append(stretch(section, last, [F.lit("")], some, first=FIGURE_LINES))
    framed = (
        totals.select("doc_id", F.explode(F.filter(F.array(*frame), lambda x: x.isNotNull())).alias("f"))
        .select("doc_id", "f.section", "f.ord", "f.first", F.posexplode("f.lines").alias("line_no", "line"))
        .withColumn("line_no", F.col("line_no") + F.col("first"))
        .drop("first")
    )

    on_one_line = F.replace("description", F.lit("\n"), F.lit(" "))
    shown = on_one_line if display is None else F.left(on_one_line, F.lit(display))
    name = F.format_string("- `%s` [%s]", "figure_id", "classification")
    pending = F.concat(name, F.lit(" → `"), F.col("image_path"), F.lit("`"))
    lines = (
        F.when(F.col("status") == S.RESOLVED_LOCAL, F.array(F.concat(name, F.lit(" "), shown)))
        .when(F.col("status") == S.RESOLVED_EXTERNAL, F.array(name))
        .when(shown == "", F.array(pending))
        .otherwise(F.array(pending, F.concat(F.lit("  "), shown)))
    )
    section = F.lit(None).cast("int")
    for number, status, *_ in ROLLUP_SECTIONS:
        section = F.when(F.col("status") == status, number).otherwise(section)
    listed = rollup_detail(statuses, chars).select(
        "doc_id",
        section.alias("section"),
        ordinal.alias("ord"),
        F.posexplode(lines).alias("line_no", "line"),
    )
    return framed.unionByName(listed)


def markdown_parts(lines: DataFrame, *, width: int = 10_000) -> DataFrame:
    """Join lines into texts (doc_id, section, part, text) of at most ``width`` figures each."""
    ordered = F.sort_array(F.collect_list(F.struct("ord", "line_no", "line")))
    return (
        lines.withColumn("part", segment_of("ord", width))
        .groupBy("doc_id", "section", "part")
        .agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))
    )


def figure_markdown(figures: DataFrame) -> DataFrame:
    """Description file and metadata JSON of each figure."""
    return figures.select(
        "doc_id",
        "figure_id",
        F.concat(
            F.lit("# "),
            F.col("figure_id"),
            F.lit("\n\n"),
            F.col("derived.description.text"),
            F.lit("\n"),
        ).alias("description_md"),
        F.to_json(
            F.struct(
                F.struct(
                    F.col("figure_id").alias("id"),
                    *[c for c in figures.columns if c not in ("doc_id", "ord", "figure_id", "width", "height")],
                ).alias("figure")
            )
        ).alias("meta_json"),
    )

"""Joins between figures, statuses and analyses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill import schemas as S
from leafmill.functions import text as T

KEY = ["doc_id", "figure_id"]

# Texts written when a status is folded into its figure.
FOLD_RATIONALE = "local_llm classification"
PENDING_EXTERNAL = "Pending external LLM processing."
SKIPPED = "Skipped"


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def fold_statuses(figures: DataFrame, statuses: DataFrame) -> DataFrame:
    """Let the status class and description replace the figure's rule-based ones.

    Figures without a status stay as they are.
    """
    found = statuses.select(
        *KEY,
        F.lit(True).alias("__found"),
        F.col("stage").alias("__stage"),
        F.col("local_llm_classification").alias("__label"),
        F.col("local_llm_description").alias("__text"),
        F.coalesce("confidence", F.lit(0.0)).alias("__conf"),
    )
    old = F.col("derived.description")
    has_label = F.coalesce("__found", F.lit(False)) & _filled("__label")
    local_notes = F.when(
        _filled("__label"), F.concat(F.lit("local_llm ("), F.col("__label"), F.lit(")"))
    ).otherwise("local_llm")

    classification = F.when(
        has_label,
        F.struct(
            F.col("__label").alias("type"),
            F.col("__conf").alias("confidence"),
            F.lit(FOLD_RATIONALE).alias("rationale"),
        ),
    ).otherwise(F.col("classification"))

    def description(text: Column, confidence: Column, notes: Column) -> Column:
        return F.struct(
            text.alias("text"), confidence.alias("confidence"), notes.alias("notes")
        )

    folded = (
        F.when(F.col("__found").isNull(), old)
        .when(_filled("__text"), description(F.col("__text"), F.col("__conf"), local_notes))
        .when(
            F.col("__stage") == "skip",
            description(
                F.coalesce("__text", F.lit(SKIPPED)), old["confidence"], F.lit("skipped")
            ),
        )
        .otherwise(
            description(
                F.lit(PENDING_EXTERNAL), old["confidence"], F.lit(S.NEEDS_EXTERNAL)
            )
        )
    )
    out = {
        "classification": classification,
        "derived": F.struct(folded.alias("description")),
    }
    return figures.join(found, KEY, "left").select(
        *[out[c].alias(c) if c in out else F.col(c) for c in figures.columns]
    )


def orphans(artifacts: DataFrame, figures: DataFrame) -> DataFrame:
    """Artifacts (doc_id, path) whose file name no figure of the document refers to."""
    used = figures.where(_filled("image_path")).select(
        "doc_id", T.file_name("image_path").alias("__name")
    )
    named = artifacts.withColumn("__name", T.file_name("path"))
    return named.join(used, ["doc_id", "__name"], "left_anti").select(*artifacts.columns)


def external_queue(figures: DataFrame, statuses: DataFrame, analyses: DataFrame) -> DataFrame:
    """Figures still to be analysed: pending or without a status, and without an analysis."""
    status = statuses.select(*KEY, F.col("status").alias("__status"))
    pending = figures.join(status, KEY, "left").where(
        F.col("__status").isNull() | (F.col("__status") == S.NEEDS_EXTERNAL)
    )
    return pending.drop("__status").join(analyses.select(*KEY), KEY, "left_anti")


def latest(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Newest row per key; one partial aggregate, no sort, and a hot key is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*by)).alias("__row")
    ).select(*keys, "__row.*")


def apply_external(statuses: DataFrame, analyses: DataFrame) -> DataFrame:
    """Mark analysed figures as resolved externally and store result, provider and model.

    ``analyses`` has one row per figure (see :func:`latest`) with ``result``
    (variant), ``provider`` and ``model``.
    """
    found = analyses.select(
        *KEY,
        F.lit(True).alias("__found"),
        F.col("result").alias("__result"),
        F.col("provider").alias("__provider"),
        F.col("model").alias("__model"),
    )
    hit = F.coalesce("__found", F.lit(False))
    out = {
        "status": F.when(hit, S.RESOLVED_EXTERNAL).otherwise(F.col("status")),
        "needs_external": F.when(hit, False).otherwise(F.col("needs_external")),
        "external_llm_result": F.when(hit, F.col("__result")).otherwise(
            F.col("external_llm_result")
        ),
        "external_llm_provider": F.when(hit, F.coalesce("__provider", F.lit(""))).otherwise(
            F.col("external_llm_provider")
        ),
        "external_llm_model": F.when(hit, F.coalesce("__model", F.lit(""))).otherwise(
            F.col("external_llm_model")
        ),
    }
    return statuses.join(found, KEY, "left").select(
        *[out[c].alias(c) if c in out else F.col(c) for c in statuses.columns]
    )


def restrict_to(figures: DataFrame, ids: DataFrame) -> DataFrame:
    """Only the listed figures."""
    return figures.join(ids.select(*KEY), KEY, "left_semi")


def audit_consistency(report: DataFrame, statuses: DataFrame) -> DataFrame:
    """Figures on which report and rollup disagree.

    ``missing`` - only one side knows the figure; ``class`` - the classes differ
    although triage gave one; ``routing`` - triage waits for an external analysis
    but the report recommends nothing.
    """
    left = report.select(
        *KEY,
        F.col("classification.type").alias("report_class"),
        F.col("recommended_manual_action").alias("action"),
    )
    right = statuses.select(
        *KEY, F.col("local_llm_classification").alias("status_class"), "status"
    )
    joined = left.join(right, KEY, "full_outer")
    issue = (
        F.when(F.col("report_class").isNull() | F.col("status").isNull(), "missing")
        .when(
            (F.coalesce("status_class", F.lit("")) != "")
            & ~F.col("report_class").eqNullSafe(F.col("status_class")),
            "class",
        )
        .when((F.col("status") == S.NEEDS_EXTERNAL) & (F.col("action") == "none"), "routing")
    )
    return joined.withColumn("issue", issue).where(F.col("issue").isNotNull())

"""Routing of figures: settled locally or handed to an external analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill import schemas as S
from leafmill.functions import rules as R
from leafmill.functions import text as T
from leafmill.functions.rules import Rule

# Noise limit in pixels, shortest sufficient description (strictly longer counts),
# texts, provider and confidences of a triage record.
NOISE_PIXELS = 500
MIN_DESCRIPTION = 50
FILE_NOT_FOUND = "File not found"
NOISE_TEXT = "Image too small to be meaningful (%dx%d)"
LOCAL_PROVIDER = "ollama"
RESOLVED_CONFIDENCE = 0.7
PENDING_CONFIDENCE = 0.3
# Placeholder description and its notes.
PENDING_LOCAL = "Pending local LLM processing."
RECOMMENDED = "LLM recommended"
RECOMMENDED_CLASSES = ("plot", "timing_diagram", "block_diagram", "state_machine")

KEY = ["doc_id", "figure_id"]


def is_noise(width: Column, height: Column, limit: int = NOISE_PIXELS) -> Column:
    return width.cast("bigint") * height < limit


def is_resolved_locally(label: Column, description: Column) -> Column:
    """Simple classes are settled, complex ones never; others need a long enough description."""
    return (
        F.when(label.isin(*S.SIMPLE_CLASSES), True)
        .when(label.isin(*S.COMPLEX_CLASSES), False)
        .otherwise(F.length(description) > MIN_DESCRIPTION)
    )


def baseline_description(figures: DataFrame) -> DataFrame:
    """Add the ``derived`` placeholder that stands until a description arrives."""
    notes = F.when(
        F.col("classification.type").isin(*RECOMMENDED_CLASSES), RECOMMENDED
    ).otherwise("none")
    return figures.withColumn(
        "derived",
        F.struct(
            F.struct(
                F.lit(PENDING_LOCAL).alias("text"),
                F.lit(0.0).alias("confidence"),
                notes.alias("notes"),
            ).alias("description")
        ),
    )


def _no_text() -> Column:
    return F.lit("")


def new_status(figures: DataFrame, model: str = "", provider: str = LOCAL_PROVIDER) -> DataFrame:
    """Blank status record per figure: everything is pending until shown otherwise."""
    return figures.select(
        *KEY,
        F.col("image_path"),
        F.lit(S.NEEDS_EXTERNAL).alias("status"),
        _no_text().alias("stage"),
        F.lit(provider).alias("local_llm_provider"),
        F.lit(model).alias("local_llm_model"),
        _no_text().alias("local_llm_description"),
        _no_text().alias("local_llm_classification"),
        _no_text().alias("external_llm_provider"),
        _no_text().alias("external_llm_model"),
        F.lit(None).cast("variant").alias("external_llm_result"),
        F.lit(True).alias("needs_external"),
        F.lit(0.0).alias("confidence"),
        F.lit(None).cast("timestamp").alias("processed_at"),
    )


def _outcome(
    status: Column,
    stage: Column | str,
    label: Column | str,
    text: Column | str,
    confidence: Column | float,
) -> Column:
    def lit(x):
        return x if isinstance(x, Column) else F.lit(x)

    return F.struct(
        status.alias("status"),
        lit(stage).alias("stage"),
        lit(label).alias("label"),
        lit(text).alias("text"),
        lit(confidence).cast("double").alias("confidence"),
    )


def triage(
    figures: DataFrame,
    responses: DataFrame,
    existing: DataFrame | None = None,
    *,
    force: bool = False,
    model: str = "",
    provider: str = LOCAL_PROVIDER,
    now: Column | None = None,
    rules: Sequence[Rule] = R.DESCRIPTION_RULES,
) -> DataFrame:
    """One status record per figure.

    Figures carry image_path (null or empty when the file is missing), width and
    height.  A figure that already has a status keeps it unless ``force``.
    ``now`` is the stamp of this run and defaults to the current time.
    """
    now = F.current_timestamp() if now is None else now
    todo = figures.select(*KEY, "image_path", "width", "height")
    keep = existing is not None and not force
    if keep:
        known = existing.select(*KEY, F.struct(*S.STATUS_COLUMNS).alias("__kept"))
        todo = todo.join(known, KEY, "left")

    # Everything that reads the text is computed below the join, once per response;
    # above it only short columns are compared.
    replies = responses.select(*KEY, F.coalesce(T.strip("response"), F.lit("")).alias("reply"))
    read = R.infer_label(
        replies.withColumn("valid", T.is_valid_description("reply")), "reply", rules
    )
    judged = todo.join(read, KEY, "left").select(
        *KEY,
        F.coalesce("image_path", F.lit("")).alias("image_path"),
        "width",
        "height",
        F.coalesce("reply", F.lit("")).alias("reply"),
        F.coalesce("valid", F.lit(False)).alias("valid"),
        "label",
        *(["__kept"] if keep else []),
    )
    settled = F.lit(S.RESOLVED_LOCAL)
    resolved = is_resolved_locally(F.col("label"), F.col("reply"))
    ladder = (
        F.when(F.col("image_path") == "", _outcome(settled, "skip", "", FILE_NOT_FOUND, 0.0))
        .when(
            is_noise(F.col("width"), F.col("height")),
            _outcome(
                settled, "skip", "noise", F.format_string(NOISE_TEXT, "width", "height"), 1.0
            ),
        )
        .when(
            F.col("valid"),
            _outcome(
                F.when(resolved, S.RESOLVED_LOCAL).otherwise(S.NEEDS_EXTERNAL),
                "local_llm",
                F.col("label"),
                F.col("reply"),
                F.when(resolved, RESOLVED_CONFIDENCE).otherwise(PENDING_CONFIDENCE),
            ),
        )
        .when(
            F.col("reply") != "",
            _outcome(F.lit(S.NEEDS_EXTERNAL), "local_llm_failed", "", "", PENDING_CONFIDENCE),
        )
        .otherwise(_outcome(F.lit(S.NEEDS_EXTERNAL), "", "", "", PENDING_CONFIDENCE))
    )
    fresh = (
        judged.withColumn("o", ladder)
        .select(
            *KEY,
            "image_path",
            F.col("o.status").alias("status"),
            F.col("o.stage").alias("stage"),
            F.lit(provider).alias("local_llm_provider"),
            F.lit(model).alias("local_llm_model"),
            F.col("o.text").alias("local_llm_description"),
            F.col("o.label").alias("local_llm_classification"),
            _no_text().alias("external_llm_provider"),
            _no_text().alias("external_llm_model"),
            F.lit(None).cast("variant").alias("external_llm_result"),
            (F.col("o.status") == S.NEEDS_EXTERNAL).alias("needs_external"),
            F.col("o.confidence").alias("confidence"),
            now.cast("timestamp").alias("processed_at"),
            *(["__kept"] if keep else []),
        )
    )
    if not keep:
        return fresh
    found = F.col("__kept").isNotNull()
    return fresh.select(
        *KEY,
        *[F.when(found, F.col("__kept")[c]).otherwise(F.col(c)).alias(c) for c in S.STATUS_COLUMNS if c not in KEY],
    )

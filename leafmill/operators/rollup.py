"""Progress counts; all are partial aggregates, so a hot document is reduced before the shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill import schemas as S
from leafmill.functions import text as T

# Defaults of the longest description in the rollup, and in its Markdown form.
DESCRIPTION_MAX = 120
DISPLAY_MAX = 80


STATUSES = (S.RESOLVED_LOCAL, S.RESOLVED_EXTERNAL, S.NEEDS_EXTERNAL)


def status_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_figures"),
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
    ]


def rollup_of_changes(changes: DataFrame, *by: Column | str) -> DataFrame:
    """Rollup counts of what entries and withdrawals (``delta`` 1 and -1) leave; groups of none are left out."""
    each = [F.sum(F.when(F.col("status") == s, F.col("delta")).otherwise(0)).alias(s) for s in STATUSES]
    counts = changes.groupBy(*by).agg(F.sum("delta").alias("total_figures"), *each)
    return with_summary(counts.where("total_figures > 0"))


def with_summary(df: DataFrame) -> DataFrame:
    done = F.col(S.RESOLVED_LOCAL) + F.col(S.RESOLVED_EXTERNAL)
    return (
        df.withColumn("fully_processed", done)
        .withColumn("pending_external", F.col(S.NEEDS_EXTERNAL))
        .withColumn("percent_complete", T.percent(done, F.col("total_figures")))
    )


def rollup_by_document(statuses: DataFrame, docs: DataFrame | None = None, *more: Column) -> DataFrame:
    """Counts and completion per document; documents of ``docs`` without statuses get zeros.

    ``more`` are further numeric aggregates of a document's statuses.
    """
    counts = statuses.groupBy("doc_id").agg(*status_counts(), *more)
    if docs is not None:
        counts = docs.select("doc_id").join(counts, "doc_id", "left").na.fill(0)
    return with_summary(counts)


def rollup_global(statuses: DataFrame) -> DataFrame:
    """The per-document rows and one row over everything (``doc_id`` null, ``is_global`` 1).

    No statuses, no rows.
    """
    counts = statuses.rollup("doc_id").agg(F.grouping("doc_id").alias("is_global"), *status_counts())
    return with_summary(counts).where(F.col("total_figures") > 0)


def rollup_detail(statuses: DataFrame, chars: int | None = DESCRIPTION_MAX) -> DataFrame:
    """One row per figure with a known status, holding what its list in the rollup shows.

    Descriptions are cut after ``chars`` characters; None keeps them whole.
    """
    described = F.coalesce("local_llm_description", F.lit(""))
    external = F.col("status") == S.RESOLVED_EXTERNAL
    return statuses.where(
        F.col("status").isin(S.RESOLVED_LOCAL, S.NEEDS_EXTERNAL, S.RESOLVED_EXTERNAL)
    ).select(
        "doc_id",
        "status",
        "figure_id",
        F.coalesce("local_llm_classification", F.lit("")).alias("classification"),
        F.when(F.col("status") == S.NEEDS_EXTERNAL, F.col("image_path")).alias("image_path"),
        F.when(
            ~external,
            described if chars is None else F.left(described, F.lit(chars)),
        ).alias("description"),
    )


def class_breakdown(statuses: DataFrame, analyses: DataFrame | None = None) -> DataFrame:
    """Figures per status and class: local classes, and those of the external analyses."""
    local = statuses.select(
        F.lit("local").alias("source"),
        "status",
        F.coalesce("local_llm_classification", F.lit("")).alias("classification"),
    )
    if analyses is not None:
        local = local.unionByName(
            analyses.select(
                F.lit("external").alias("source"),
                F.lit(S.RESOLVED_EXTERNAL).alias("status"),
                F.coalesce("classification", F.lit("")).alias("classification"),
            )
        )
    return local.groupBy("source", "status", "classification").agg(
        F.count(F.lit(1)).alias("figures")
    )


def class_breakdown_wide(statuses: DataFrame) -> DataFrame:
    """Local classes by document status, one column per status."""
    return (
        statuses.groupBy(F.coalesce("local_llm_classification", F.lit("")).alias("classification"))
        .agg(
            *[
                F.count_if(F.col("status") == s).alias(s)
                for s in (S.RESOLVED_LOCAL, S.NEEDS_EXTERNAL, S.RESOLVED_EXTERNAL)
            ]
        )
    )


def _kept_count(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("doc_id").agg(F.count(F.lit(1)).alias(name))


def doc_stats(
    docs: DataFrame,
    blocks: DataFrame | None = None,
    tables: DataFrame | None = None,
    figures: DataFrame | None = None,
) -> DataFrame:
    """Counts per document after all filters; 0 where there is nothing.

    ``docs`` is the manifest (doc_id, page_count).  The children are counted in
    one pass over their union.
    """
    kinds = {"block_count": blocks, "table_count": tables, "figure_count": figures}
    given = {k: v for k, v in kinds.items() if v is not None}
    base = docs.select("doc_id", "page_count")
    if not given:
        return base.select("*", *[F.lit(0).cast("bigint").alias(k) for k in kinds])
    rows = reduce(
        DataFrame.unionByName,
        [v.select("doc_id", F.lit(k).alias("kind")) for k, v in given.items()],
    )
    counts = rows.groupBy("doc_id").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])
    return base.join(counts, "doc_id", "left").select(
        "doc_id",
        "page_count",
        *[F.coalesce(k, F.lit(0)).cast("bigint").alias(k) for k in kinds],
    )


def all_items(**children: DataFrame) -> DataFrame:
    """Blocks, tables and figures as one table (doc_id, kind, id, page)."""
    return reduce(
        DataFrame.unionByName,
        [df.select("doc_id", F.lit(kind).alias("kind"), "id", "page") for kind, df in children.items()],
    )


def smoke_checks(docs: DataFrame, stats: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(doc_id, failure) per document that lacks outputs.

    ``artifacts`` lists what exists as (doc_id, kind) with kinds document, index,
    figure and table.
    """
    kinds = ("document", "index", "figure", "table")
    have = artifacts.groupBy("doc_id").agg(
        *[F.count_if(F.col("kind") == k).alias(f"__{k}") for k in kinds]
    )
    joined = (
        docs.select("doc_id")
        .join(stats.drop("page_count"), "doc_id", "left")
        .join(have, "doc_id", "left")
        .na.fill(0)
    )
    no_document = F.col("__document") == 0
    no_index = ~no_document & (F.col("__index") == 0)
    readable = ~no_document & ~no_index
    total = F.col("block_count") + F.col("table_count") + F.col("figure_count")
    checks = {
        "missing document": no_document,
        "missing index": no_index,
        "empty extraction": readable & (total <= 0),
        "figures missing image": readable & (F.col("figure_count") > 0) & (F.col("__figure") == 0),
        "tables missing markdown": readable & (F.col("table_count") > 0) & (F.col("__table") == 0),
    }
    failures = F.filter(
        F.array(*[F.when(test, name) for name, test in checks.items()]), lambda f: f.isNotNull()
    )
    return joined.select("doc_id", F.explode(failures).alias("failure"))

"""From raw documents to packed training sequences, in five stages.

Each stage is an operator of ``leafmill.llm`` applied to all that the stage before it kept.  The
results are written to the shared folder and read again, so a stage can be repeated on its own.

For every stage: rows count one by one, whatever their ids (null or repeated); all columns of documents
come out as they went in, under any names; texts of any length are used as a whole; an empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import numbered, only, shipped
from leafmill.llm.exact_dedup import exact_dedup
from leafmill.llm.near_dedup import near_dedup
from leafmill.llm.packing import pack
from leafmill.llm.quality_rules import quality_rules
from leafmill.llm.queries import tokenizer
from leafmill.llm.secret_scan import redacted
from leafmill.scratch import settle


def kept(docs: DataFrame, judge: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps; rows are matched by number, not by id."""
    held, row = numbered(docs, "documents")
    stay = settle(judge(held, row).where("kept").select(F.col("rid").alias(row)), "kept")
    return only(held, stay, row).select(*[f"`{c}`" for c in docs.columns])


@shipped
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and read like trusted text; a null or empty text fails them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return kept(docs, lambda d, row: quality_rules(d, labels, rid_col=row))


@shipped
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts, white space aside; null and empty texts are one set.

    The longest stays, then the smallest id, then the first of identical rows.
    """
    return kept(docs, lambda d, row: exact_dedup(d, rid_col=row))


@shipped
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates; texts without words are one class.

    Of ties the operator's order decides, so reruns keep the same row.
    """
    return kept(docs, lambda d, row: near_dedup(d, rid_col=row))


@shipped
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; n_chars follows where a text changes.  A null text stays null."""
    masked = redacted(docs)
    if "n_chars" not in docs.columns:
        return masked
    n = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.when(F.col("text").contains("<secret>"), n).otherwise(F.col("n_chars")))


@shipped
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a sequence; a null or empty text is its end mark.

    Tokens aren't stored: a piece is (doc_id, start, length), and ``packing.pack`` with ids gives them.
    """
    return pack(docs, tokenizer()).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("secret_scan", secrets),
    ("packing", packing),
]

# Near-duplicate classes, the field's tags and the packing plan are beyond SQL; tests compare each
# stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs

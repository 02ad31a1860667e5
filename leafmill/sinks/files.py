"""File sinks for records and rendered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill import schemas as S
from leafmill.operators.lifecycle import KEY, apply_external
from leafmill.sinks import runs
from leafmill.sources.files import read_statuses


def write_records(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Nested records as JSON lines (or another format), overwriting ``path``."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Rendered Markdown lines, range-sorted so that concatenated files read in order.

    The sort columns reach below the document, so a huge one is split over files.
    """
    order = ["doc_id", "section", "ord", "line_no"]
    (
        lines.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(F.col("line").alias("value"))
        .write.mode("overwrite")
        .text(path)
    )


def write_statuses(statuses: DataFrame, path: str, run: int) -> None:
    """Put status records, one per figure, into the store at ``path``; others keep theirs.

    The store is kept as runs by (doc_id, figure_id) and read by ``sources.files.read_statuses``.  Call
    ``runs.merge_runs`` now and then: it keeps the number of runs that a reader looks at small.
    """
    runs.write_run(statuses.select(*S.STATUS_COLUMNS), None, path, run, KEY)


def remove_statuses(figures: DataFrame, path: str, run: int) -> None:
    """Forget the statuses of some (doc_id, figure_id)."""
    spark = figures.sparkSession
    runs.write_run(read_statuses(spark, path).limit(0), figures, path, run, KEY)


def store_analyses(analyses: DataFrame, path: str, run: int) -> None:
    """Resolve figures by external analyses, one row per figure; only their records are written."""
    statuses = read_statuses(analyses.sparkSession, path)
    touched = statuses.join(analyses.select(*KEY), KEY, "left_semi")
    write_statuses(apply_external(touched, analyses), path, run)

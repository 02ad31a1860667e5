"""What the operators share: row ids, hashes of texts, and joins that survive hot groups."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.scratch import settle

WORD = r"[^\x20\x09-\x0D]+"
"""A word: a maximal run of anything but ASCII white space."""

HOT_SHARE = 512
"""A group with over 1/512 of all rows is hot; there are fewer than 512 such groups at any size."""


def texts_of(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rid_col: str | None = None
) -> DataFrame:
    """(rid, id, text) of a table that may have any other columns; a null text is empty.

    ``rid_col`` names a column that numbers the rows; without one they are numbered here.
    """
    return docs.select(
        (F.col(f"`{rid_col}`") if rid_col else F.monotonically_increasing_id()).alias("rid"),
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def unused(name: str, columns: Sequence[str], *suffixes: str) -> str:
    """``name`` with as many underscores as keep it, and it with any suffix, apart from ``columns``."""
    taken = {c.lower() for c in columns}
    while any((name + s).lower() in taken for s in ("", *suffixes)):
        name += "_"
    return name


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with a row number in a new column, and that column's name.

    So null or repeated ids don't matter.  Rows of a Parquet table are numbered by file and place in
    it, which no rerun changes and which costs no copy; those of any other plan are written once with
    a number.  The driver sees the names of the files.
    """
    rid_col = unused("rid", docs.columns, "_file", "_row", "_no")
    file, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    try:
        located = docs.select("*", file.alias(f"{rid_col}_file"), place.alias(f"{rid_col}_row"))
    except AnalysisException:
        return settle(docs.withColumn(rid_col, F.monotonically_increasing_id()), name), rid_col
    spark = docs.sparkSession
    paths = sorted(r[0] for r in docs.select(file).distinct().collect())
    files = spark.createDataFrame(list(enumerate(paths)), f"{rid_col}_no long, {rid_col}_file string")
    rid = F.shiftleft(F.col(f"{rid_col}_no"), 40) + F.col(f"{rid_col}_row")
    rows = located.join(F.broadcast(files), f"{rid_col}_file")
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], rid.alias(rid_col)), rid_col


def bucket_of(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def attach(
    rows: DataFrame, groups: DataFrame, on: Sequence[str], size: str, total: int
) -> DataFrame:
    """Inner join of ``rows`` with one row per group, where a group may hold most rows.

    Groups with over ``total / HOT_SHARE`` rows are fewer than HOT_SHARE, so they are broadcast
    and their rows don't move; all others are joined by a shuffle in which no key is hot.
    ``rows`` is read three times: pass a written table.
    """
    hot = groups.where(F.col(size) * HOT_SHARE > total)
    cold = groups.where(F.col(size) * HOT_SHARE <= total)
    still = rows.join(F.broadcast(hot), list(on), "inner")
    rest = rows.join(F.broadcast(hot.select(*on)), list(on), "left_anti").join(cold, list(on))
    return still.unionByName(rest)


def release() -> None:
    """Give freed memory back to the system: an idle worker stays for a while beside other stages."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


BROADCAST_KEYS = 1 << 20
"""So many keys of a few bytes each may be broadcast."""


def only(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows whose ``on`` is among ``keys``, a written table of distinct values.

    Up to BROADCAST_KEYS keys are broadcast, after counting them, so that wide rows stay where they
    are; more are joined by a shuffle.
    """
    few = keys.count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if few else keys, on, "left_semi")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the workers of this application import the package, once; nothing else is needed there."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        made = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="leafmill-"), "leafmill"), "zip", root, "leafmill"
        )
        context.addPyFile(made)
        _shipped.add(context.applicationId)


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query or stage whose workers can import the package."""

    @wraps(query)
    def run(spark: SparkSession, *args: object) -> DataFrame:
        ship(spark)
        return query(spark, *args)

    return run

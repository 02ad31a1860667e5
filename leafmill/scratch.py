"""Intermediate tables in the shared folder that the cluster names.

A written table cuts lineage for good: it survives lost executors, is read back
column by column, and spares a plan that uses it twice from computing it twice.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_passing: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset (tests on one machine) a temporary folder is made and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="leafmill-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str, *, lasting: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet scratch table now and return a reader of it.

    Within :func:`passing` the table goes when that ends; a ``lasting`` one stays for the outermost
    of the scopes around that, or for good if there is none.
    """
    path = scratch(df.sparkSession, name)
    scopes = _passing.get()
    for made in scopes[:-1][:1] if lasting else scopes[-1:]:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete folders or files, in whatever store they are."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = hadoop_path(path)
        place.getFileSystem(conf).delete(place, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """A stretch of work that leaves nothing behind but what it returns or stores.

    Scratch tables settled within are removed at its end, and the shuffle files of every action as soon as
    it has ended: a long run holds those of one action, not of all.
    """
    made: list[str] = []
    token = _passing.set((*_passing.get(), made))
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
        _passing.reset(token)
        remove(spark, made)

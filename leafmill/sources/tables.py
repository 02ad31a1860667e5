"""Tables of documents as input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose rows carry long texts.

    Parsing texts is CPU-bound, and a file of one row group is one task however
    many slots are free.  Only a table of one file with fewer splits than slots is
    dealt out, once; tables of many files are never moved.  The deal is round-robin,
    so it promises no partitioning that later steps would rely on.
    """
    df = spark.read.parquet(path)
    slots = spark.sparkContext.defaultParallelism
    small = len(df.inputFiles()) == 1 and df.rdd.getNumPartitions() < slots
    return df.repartition(slots) if small else df

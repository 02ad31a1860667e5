"""File sources: manifests, status and analysis records, images."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill import schemas as S
from leafmill.functions import text as T
from leafmill.sinks import runs

# Fixed value: the default file pattern; only it falls back to a recursive search.
DEFAULT_GLOB = "*.pdf"
FILE_COLUMNS = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _binary(spark: SparkSession, directory: str, glob: str, recursive: bool) -> DataFrame:
    try:
        return (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", str(recursive).lower())
            .load(directory)
        )
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], FILE_COLUMNS)


def discover(spark: SparkSession, directory: str, glob: str = DEFAULT_GLOB) -> DataFrame:
    """Files of a directory matching ``glob`` as (path, modificationTime, length, content).

    Only when the default pattern finds nothing at the top level is the whole
    tree searched.  The check reads one file name; ``content`` is read only by
    those who select it.
    """
    top = _binary(spark, directory, glob, recursive=False)
    if glob != DEFAULT_GLOB or not top.select("path").isEmpty():
        return top
    return _binary(spark, directory, glob, recursive=True)


def source_manifest(files: DataFrame, content: str = "content", path: str = "path") -> DataFrame:
    """path, sha256, size in bytes and modification time of each source."""
    body = F.col(content).cast("binary")
    kept = [c for c in ("doc_id",) if c in files.columns]
    stamp = F.col("modificationTime") if "modificationTime" in files.columns else F.lit(None)
    return files.select(
        *kept,
        F.col(path).alias("path"),
        F.sha2(body, 256).alias("sha256"),
        F.octet_length(body).cast("bigint").alias("size"),
        stamp.cast("timestamp").alias("mtime"),
    )


def source_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """(path, change, sha256, sha256_before) of every source in either manifest.

    ``change`` is new, changed, deleted, touched (another time, the same bytes) or same.
    """
    old = before.select(
        "path", F.col("sha256").alias("sha256_before"), F.col("mtime").alias("__mtime"), F.lit(True).alias("__old")
    )
    both = now.withColumn("__new", F.lit(True)).join(old, "path", "full_outer")
    change = (
        F.when(F.col("__old").isNull(), "new")
        .when(F.col("__new").isNull(), "deleted")
        .when(~F.col("sha256").eqNullSafe(F.col("sha256_before")), "changed")
        .when(~F.col("mtime").eqNullSafe(F.col("__mtime")), "touched")
        .otherwise("same")
    )
    return both.select("path", change.alias("change"), "sha256", "sha256_before")


def epoch_seconds(mtime: Column) -> Column:
    """Modification time as floating-point seconds."""
    return F.unix_micros(mtime) / F.lit(1e6)


def stem_collisions(manifest: DataFrame) -> DataFrame:
    """Stems that more than one source maps to; their outputs would overwrite each other."""
    return (
        manifest.groupBy(T.file_stem("path").alias("stem"))
        .agg(F.count(F.lit(1)).alias("sources"))
        .where("sources > 1")
    )


def doc_of_path(path: Column, levels_up: int) -> Column:
    """Directory name ``levels_up`` above the file: 1 is the folder that holds it."""
    return F.url_decode(F.element_at(F.split(path, "/"), -1 - levels_up))


def read_statuses(spark: SparkSession, path: str, glob: str = "fig_*.json") -> DataFrame:
    """Status records at ``path``: those of a store (see ``sinks.files.write_statuses``), else files.

    Files are ``<doc>/processing/fig_*.json``; absent fields become null.  A tree of files is taken
    over by writing what is read from it into a store.

    An early variant stores the external model under ``external_llm_meta``; it
    fills the model column when that is empty.
    """
    if runs.has_runs(spark, path):
        return runs.read_runs(spark, path).select(*S.STATUS_COLUMNS)
    raw = (
        spark.read.schema(S.STATUS_FILE)
        .option("multiLine", True)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .json(path)
        .withColumn("doc_id", doc_of_path(F.col("_metadata.file_path"), 2))
    )
    model = F.coalesce(
        F.nullif("external_llm_model", F.lit("")), "external_llm_meta.model", "external_llm_model"
    )
    return raw.withColumn("external_llm_model", model).select(*S.STATUS_COLUMNS)


def read_analyses(
    spark: SparkSession, path: str, glob: str = "*.json", levels_up: tuple[int, int] = (4, 1)
) -> DataFrame:
    """Analysis files ``<doc>/derived/figures/<figure>/<name>.json``.

    ``levels_up`` says how far above the file the document and figure names are.  Besides the known
    fields there is ``record``, the whole file as a variant, so that no field is lost (see
    ``analysis.schema_drift``); it is null for a file that isn't JSON, whose other fields are null too.
    """
    doc, figure = levels_up
    text = F.decode("content", "UTF-8")
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("_metadata.file_path").alias("file"), text.alias("value"))
        .select("file", F.from_json("value", S.ANALYSIS_FILE).alias("a"), F.try_parse_json("value").alias("record"))
        .select(
            doc_of_path(F.col("file"), doc).alias("doc_id"),
            doc_of_path(F.col("file"), figure).alias("figure_id"),
            *[F.col("a")[c].alias(c) for c in S.ANALYSIS_COLUMNS],
            "record",
        )
    )


def read_figure_images(spark: SparkSession, path: str, glob: str = "fig_*.png") -> DataFrame:
    """(image_path, width, height, pixels) of the readable images below ``path``."""
    return (
        spark.read.format("image")
        .option("dropInvalid", True)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.col("image.origin").alias("image_path"),
            F.col("image.width").alias("width"),
            F.col("image.height").alias("height"),
            (F.col("image.width").cast("bigint") * F.col("image.height")).alias("pixels"),
        )
    )

"""From a folder of markup files to a stored run, and again for what has changed since."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.plans import corpus
from leafmill.scratch import settle
from leafmill.sinks import runs
from leafmill.sources import files, markup

MANIFEST = "path STRING, sha256 STRING, size BIGINT, mtime TIMESTAMP"


def relative_to(directory: str, path: Column) -> Column:
    """The path below ``directory``, which identifies a document: equal stems don't collide."""
    root = directory.rstrip("/").split("://")[-1]
    return F.url_decode(F.regexp_replace(path, F.lit(rf"^.*?\Q{root}\E/"), F.lit("")))


def changed_files(spark: SparkSession, directory: str, before: DataFrame, glob: str) -> tuple[DataFrame, DataFrame]:
    """The manifest of a folder, and the contents of files whose size or time isn't the stored one.

    Only those files are read and hashed; the others keep their digests.  Their paths pass through the
    driver, which has the folder's whole listing anyway.
    """
    listed = files.discover(spark, directory, glob).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime")
    )
    known = before.select("path", "size", "mtime", "sha256")
    now = settle(listed.join(known, ["path", "size", "mtime"], "left"), "listed")
    paths = [r.path for r in now.where("sha256 is null").select("path").toLocalIterator()]
    if not paths:
        return now, spark.createDataFrame([], files.FILE_COLUMNS)
    read = spark.read.format("binaryFile").load(paths)
    fresh = files.source_manifest(read).select("path", "sha256")
    old = now.where("sha256 is not null")
    new = now.where("sha256 is null").drop("sha256").join(fresh, "path")
    return settle(old.unionByName(new), "manifest"), read


def run_folder(
    spark: SparkSession,
    directory: str,
    out: str,
    run: int,
    *,
    glob: str = "*.html",
    options: corpus.Options = corpus.Options(),
    describe: Callable[[DataFrame], DataFrame] | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Enrich the files of a folder that are new or changed since the last run, and store the results.

    Returns (path, change, ...) of every file, see ``files.source_changes``.  A file that is gone has
    all its results cleared; one that was only touched, or is the same, keeps them untouched and isn't
    read as a document.  ``describe`` maps raw figures with ids to model responses.  ``run`` must grow;
    a run that died is done again with the same number.
    """
    store = f"{out}/sources"
    before = runs.read_runs(spark, store) if runs.has_runs(spark, store) else spark.createDataFrame([], MANIFEST)
    manifest, read = changed_files(spark, directory, before, glob)
    changes = settle(files.source_changes(manifest, before), "changes")
    fresh = changes.where("change in ('new', 'changed')").select("path")
    gone = changes.where("change = 'deleted'").select("path")
    if changes.where("change not in ('same')").isEmpty():
        return changes
    doc = relative_to(directory, F.col("path"))
    pages = settle(
        read.join(fresh, "path", "left_semi").select(
            doc.alias("doc_id"), "path", F.decode("content", "UTF-8").alias("html")
        ),
        "pages",
    )
    items, tables, figures = markup.extract_structure(pages.select("doc_id", "html"), doc="doc_id")
    docs = pages.select("doc_id", "path", F.lit(1).alias("page_count"))
    responses = describe(figures) if describe else None
    done = corpus.enrich(docs, items, tables, figures, responses, options=options, now=now, home=corpus.Home(out, run))
    corpus.write(done, out, run, gone.select(doc.alias("doc_id")))
    # Last: a run that dies before this finds the same changes again.
    covered = changes.where("change != 'same'").select("path")
    runs.write_run(manifest.join(covered, "path", "left_semi"), covered, store, run, ("path",))
    return changes

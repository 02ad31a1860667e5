"""A whole corpus from extracted items to documents, statuses, reports and exports.

The stages are the operators in order; what several later stages read (blocks,
figures, statuses) is written once and read from there: where the run stores it if
that is known beforehand (``Home``), else in the scratch folder.  What only a stage needs
goes with it, scratch tables as well as shuffle files, so beside what it stores a run holds
one step's files at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import rules as R
from leafmill.functions import text as T
from leafmill.functions.rules import Rule
from leafmill.operators import (
    chunking,
    context,
    export,
    filters,
    lifecycle,
    normalize,
    report,
    rollup,
    triage,
)
from leafmill.scratch import passing, settle
from leafmill.sinks import runs


SHARES = 2
"""Nested documents are assembled in so many steps, each with its share of the records."""


@dataclass(frozen=True)
class Options:
    """What a run covers and how it decides."""

    pages: str | None = None
    force: bool = False
    no_images: bool = False
    no_tables: bool = False
    max_figures: int | None = None
    model: str = ""
    max_tokens: int = chunking.MAX_TOKENS
    tokens: chunking.Tokens = T.words
    glue: str = " "
    root: str = "out"
    figure_rules: Sequence[Rule] | DataFrame = R.FIGURE_RULES  # or a rule table, see operators/rule_index.py
    context_chars: int | None = context.CONTEXT_CHARS
    description_chars: int | None = rollup.DESCRIPTION_MAX
    display_chars: int | None = rollup.DISPLAY_MAX
    description_rules: Sequence[Rule] = R.DESCRIPTION_RULES
    tags: Sequence[str] = R.TAGS


@dataclass(frozen=True)
class Home:
    """Folder and number of the run that will store a corpus."""

    path: str
    run: int

    def of(self, name: str) -> tuple[str, int]:
        return f"{self.path}/{name}", self.run


def _keeper(
    home: Home | None, placed: set[tuple[str, int]], *, lasting: bool = False
) -> Callable[[DataFrame, str], DataFrame]:
    """Writes a table at home, which is added to ``placed``, or as a scratch table where that can't be."""

    def keep(rows: DataFrame, name: str) -> DataFrame:
        there = None if home is None else runs.place_rows(rows, *home.of(name))
        if there is None:
            return settle(rows, name, lasting=lasting)
        placed.add(home.of(name))
        return there

    return keep


@dataclass(frozen=True)
class Corpus:
    """Results of a run; branches that were switched off are None."""

    docs: DataFrame
    blocks: DataFrame
    tables: DataFrame | None
    figures: DataFrame | None
    statuses: DataFrame | None
    options: Options
    pictures: DataFrame | None = None
    """(doc_id, image_path) of all pictures that have an image, before any limit or filter."""
    placed: frozenset[tuple[str, int]] = frozenset()
    """Tables that lie already where ``write`` would store them; their runs are not committed."""

    def orphans(self) -> DataFrame:
        """Images that no figure refers to any more, after the limit and the page filter."""
        artifacts = self.pictures.select("doc_id", F.col("image_path").alias("path"))
        return lifecycle.orphans(artifacts, self.figures)

    def stats(self) -> DataFrame:
        return rollup.doc_stats(self.docs, self.blocks, self.tables, self.figures)

    def rollup(self) -> DataFrame:
        return rollup.rollup_by_document(self.statuses, self.docs)

    def rollup_global(self) -> DataFrame:
        return rollup.rollup_global(self.statuses)

    def report(self) -> DataFrame:
        return report.report_entries(self.figures)

    def nested(self, share: tuple[int, int] | None = None) -> DataFrame:
        """The documents themselves: nested records, in parts of a fixed number of children.

        ``share`` (k, n) gives the k-th of n shares of the records.
        """
        counts = F.struct("page_count", "block_count", "table_count", "figure_count")
        docs = self.docs.drop("page_count").join(self.stats(), "doc_id")
        source = F.struct(*[c for c in self.docs.columns if c not in ("doc_id", "page_count")])
        docs = docs.select("doc_id", source.alias("source"), counts.alias("doc_stats"))
        children = {"blocks": self.blocks}
        if self.tables is not None:
            children["tables"] = self.tables
        if self.figures is not None:
            children["figures"] = self.figures.withColumnRenamed("figure_id", "id")
        return export.assemble_documents(docs, **children, share=share)

    def index(self) -> DataFrame:
        """What each document produced."""
        return export.artifact_index(self.docs, self.tables, self.figures, self.options.root)

    def audit(self) -> DataFrame:
        return lifecycle.audit_consistency(self.report(), self.statuses)


def enrich(
    docs: DataFrame,
    items: DataFrame,
    raw_tables: DataFrame | None = None,
    raw_figures: DataFrame | None = None,
    responses: DataFrame | None = None,
    existing: DataFrame | None = None,
    *,
    options: Options = Options(),
    now: Column | None = None,
    home: Home | None = None,
) -> Corpus:
    """Run the stages over a corpus.

    ``docs`` has (doc_id, path, page_count); ``items`` the text with heading
    levels; raw tables and figures are those of the extraction, ``responses`` the
    model's descriptions keyed by figure, ``existing`` earlier statuses.  ``home`` says
    where :func:`write` will store the results, which spares a copy of the large tables.
    """
    with passing(docs.sparkSession):
        return _enrich(docs, items, raw_tables, raw_figures, responses, existing, options, now, home)


def _enrich(
    docs: DataFrame,
    items: DataFrame,
    raw_tables: DataFrame | None,
    raw_figures: DataFrame | None,
    responses: DataFrame | None,
    existing: DataFrame | None,
    options: Options,
    now: Column | None,
    home: Home | None,
) -> Corpus:
    placed: set[tuple[str, int]] = set()
    keep = _keeper(home, placed, lasting=True)
    docs = settle(docs, "docs", lasting=True)
    chunks = chunking.chunk_greedy(
        chunking.heading_path(items), options.max_tokens, tokens=options.tokens, glue=options.glue
    )
    numbered = normalize.normalize_blocks(chunking.to_raw_blocks(chunks))
    blocks = keep(filters.filter_pages(numbered, options.pages), "blocks")

    tables = None
    if raw_tables is not None and not options.no_tables:
        tables = keep(
            filters.filter_pages(
                normalize.normalize_tables(raw_tables, root=options.root, vocabulary=options.tags),
                options.pages,
            ),
            "tables",
        )

    if raw_figures is None or options.no_images:
        return Corpus(docs, blocks, tables, None, None, options, placed=frozenset(placed))

    # Pictures without an image leave a gap in the ids and don't count towards the limit.
    pictures = normalize.drop_imageless(raw_figures)
    figures = normalize.normalize_figures(pictures, dense=True, vocabulary=options.tags)
    figures = filters.limit_per_document(figures, options.max_figures)
    figures = filters.filter_pages(figures, options.pages)
    by = context.classify_figures_by_table if isinstance(options.figure_rules, DataFrame) else context.classify_figures
    ruled = by(figures, blocks, options.figure_rules, chars=options.context_chars)
    # A step of its own, so that the shuffles behind it are gone when statuses are folded in.
    based = triage.baseline_description(settle(ruled, "ruled"))
    if responses is None:
        responses = figures.select("doc_id", "figure_id", F.lit("").alias("response"))
    statuses = keep(
        triage.triage(
            figures,
            responses,
            existing,
            force=options.force,
            model=options.model,
            now=now,
            rules=options.description_rules,
        ),
        "statuses",
    )
    folded = keep(lifecycle.fold_statuses(based, statuses), "figures")
    shown = settle(pictures.select("doc_id", "image_path"), "pictures", lasting=True)
    return Corpus(docs, blocks, tables, folded, statuses, options, shown, frozenset(placed))


def write(corpus: Corpus, path: str, run: int, gone: DataFrame | None = None) -> None:
    """Store every artifact of a run; a rerun of a document replaces what it had.

    ``gone`` lists documents (doc_id) that no longer exist: all they had is cleared.  What covers the whole run, not a document, lies under ``run=N`` of its own.
    """
    with passing(corpus.docs.sparkSession):
        _write(corpus, path, run, gone)


def _write(corpus: Corpus, path: str, run: int, gone: DataFrame | None) -> None:
    own = corpus.docs.select("doc_id")
    docs = own if gone is None else own.unionByName(gone.select("doc_id"))

    home, placed = Home(path, run), set(corpus.placed)
    keep = _keeper(home, placed)

    def store(name: str, rows: DataFrame | list[DataFrame]) -> None:
        if home.of(name) in placed:
            runs.commit_run(docs, *home.of(name))
        else:
            runs.write_run(rows, docs, *home.of(name))

    def store_whole(name: str, rows: DataFrame) -> None:
        rows.write.options(**runs.PACKED).mode("overwrite").parquet(f"{path}/{name}/run={run:019d}")

    index = settle(corpus.index(), "index")
    store("documents", [export.to_records(corpus.nested((k, SHARES))) for k in range(SHARES)])
    store("index", export.index_records(index))
    store("blocks", corpus.blocks)
    store("doc_stats", corpus.stats())
    if corpus.tables is not None:
        store("tables", corpus.tables)
        store("table_csv", export.table_to_csv(corpus.tables))
        store("table_markdown", export.table_to_markdown(corpus.tables))
        store("table_json", export.table_to_json(corpus.tables))
    if corpus.figures is not None:
        store("figures", corpus.figures)
        store("statuses", corpus.statuses)
        store("orphans", corpus.orphans())
        store("figure_markdown", report.figure_markdown(corpus.figures))
        entries = keep(corpus.report(), "report")
        store("report", entries)
        store("report_markdown", report.report_markdown(entries, corpus.docs))
        store("rollup", corpus.rollup())
        store("rollup_detail", rollup.rollup_detail(corpus.statuses, corpus.options.description_chars))
        lines = report.rollup_markdown(
            corpus.statuses, corpus.docs, chars=corpus.options.description_chars, display=corpus.options.display_chars
        )
        store("rollup_markdown", lines)
        store_whole("global_report", report.global_report_markdown(entries))
        store_whole("global_rollup", corpus.rollup_global())
    kinds = index.select("doc_id", "kind").unionByName(own.withColumn("kind", F.lit("index")))
    store("failures", rollup.smoke_checks(corpus.docs, corpus.stats(), kinds))

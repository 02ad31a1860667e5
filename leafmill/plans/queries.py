"""Every operator bound to the driver's tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import grids as G
from leafmill.functions import rules as R
from leafmill.functions import text as T
from leafmill.functions.ordered import number_rows
from leafmill.operators import (
    analysis,
    chunking,
    context,
    describe,
    export,
    filters,
    lifecycle,
    normalize,
    report,
    rollup,
    rule_index,
    triage,
)
from leafmill.plans import bindings as B
from leafmill.plans import corpus
from leafmill.plans.session import configure
from leafmill.scratch import passing, scratch, settle
from leafmill.sinks import files as sink
from leafmill.sinks import runs
from leafmill.sources import files, markup
from leafmill.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CHUNK = 64
SPEC = "1,3-5"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def joined(c: Column | str, sep: str = "|") -> Column:
    return F.array_join(T.col(c), sep)


# --- shared inputs -----------------------------------------------------------


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.triage(
        B.figures(spark, sf_dir),
        B.responses(spark, sf_dir),
        B.existing_statuses(spark, sf_dir),
        model=B.MODEL,
        now=F.lit(B.RUN_STAMP),
        rules=B.CORPUS_DESCRIPTION_RULES,
    )


def ruled_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized figures, classified by caption and page, with placeholder descriptions."""
    raw = B.raw_figures(spark, sf_dir).drop("reply")
    figures = normalize.normalize_figures(raw, dense=True, vocabulary=B.CORPUS_TAGS)
    classified = context.classify_figures(
        figures, B.raw_blocks(spark, sf_dir), B.CORPUS_FIGURE_RULES
    )
    return triage.baseline_description(classified)


def folded_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.fold_statuses(ruled_figures(spark, sf_dir), statuses(spark, sf_dir))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_entries(folded_figures(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "documents")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = documents(spark, sf_dir).select(
        "doc_id",
        F.concat_ws("/", "source", F.format_string("%d.txt", "doc_id")).alias("path"),
        "text",
    )
    return files.source_manifest(named, content="text")


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_tables(
        B.raw_tables(spark, sf_dir), dense=True, vocabulary=B.CORPUS_TAGS
    )


def headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.heading_path(B.items(spark, sf_dir), levels=3)


def latest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.latest(
        B.status_log(spark, sf_dir), ["doc_id", "figure_id"], ["processed_at", "event_id"]
    )


def flat_figures(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id",
        "figure_id",
        "page",
        F.col("classification.type").alias("type"),
        F.col("classification.confidence").alias("class_confidence"),
        F.col("classification.rationale").alias("rationale"),
        F.col("derived.description.text").alias("description"),
        F.col("derived.description.confidence").alias("description_confidence"),
        F.col("derived.description.notes").alias("notes"),
    )


# --- sources -----------------------------------------------------------------


@query
def source_manifest(spark, sf_dir):
    return manifest(spark, sf_dir).select("doc_id", "path", "sha256", "size")


@query
def stem_collisions(spark, sf_dir):
    pages = B.table(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    return files.stem_collisions(pages)


@query
def file_names(spark, sf_dir):
    pages = B.table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", T.file_name("url").alias("name"), T.file_stem("url").alias("stem")
    )


@query
def page_blocks(spark, sf_dir):
    items = markup.page_items(B.table(spark, sf_dir, "pages"), doc="page_id")
    return items.select("doc_id", "ord", "tag", "text", "level")


@query
def page_links_as_figures(spark, sf_dir):
    links = markup.page_links_as_figures(B.table(spark, sf_dir, "pages"), doc="page_id")
    return links.select("doc_id", "ord", "image_path", "caption")


def _escaped(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    c = F.replace(c, F.lit(">"), F.lit("&gt;"))
    return F.replace(c, F.lit('"'), F.lit("&quot;"))


@query
def page_table_spans(spark, sf_dir):
    """Rows of tables whose cells span rows and columns."""
    found = markup.page_tables(B.talk_pages(spark, sf_dir))
    grid = F.concat(F.array("header"), "rows")
    return found.select("doc_id", F.posexplode(grid).alias("row", "cells")).select("doc_id", "row", joined("cells").alias("cells"))


@query
def page_tables(spark, sf_dir):
    """Each document written as one HTML table (unclosed cells, one nested) and read back."""

    def row(line: Column) -> Column:
        cells = F.transform(
            T.words(line), lambda w: F.concat(F.lit('<td class="c">'), _escaped(w))
        )
        return F.concat(F.lit("<TR>"), F.array_join(cells, ""), F.lit("</tr>"))

    body = F.array_join(F.transform(B.lines(F.col("text")), row), "\n")
    pages = documents(spark, sf_dir).select(
        "doc_id",
        F.concat(
            F.lit("<p>x<table border=1><caption>t</caption>"),
            F.replace(body, F.lit("<TR>"), F.lit("<TR><td><table><tr><td>in</table>")),
            F.lit("</table><p>after"),
        ).alias("html"),
    )
    found = markup.page_tables(pages).where("caption = 't'")
    words = lambda r: F.filter(r, lambda x: x != "")
    found = found.withColumn("header", words(F.col("header"))).withColumn(
        "rows", F.transform("rows", words)
    )
    return found.select(
        "doc_id",
        "ord",
        joined("header", " ").alias("header"),
        F.size("rows").alias("n_rows"),
        joined(F.transform("rows", lambda r: joined(r, " ")), "\n").alias("body"),
    )


@query
def page_images(spark, sf_dir):
    """Each conversation turn written as a captioned figure, attributes quoted in all ways."""
    talk = B.table(spark, sf_dir, "conversations")
    pages = talk.select(
        "conv_id",
        "turn",
        F.concat(
            F.lit("<div><figure><img data-src='lazy.png' src='img/"),
            F.col("conv_id").cast("string"),
            F.lit(".png' width="),
            F.length("text").cast("string"),
            F.lit(' height=auto alt="no src=x"><figcaption><b>'),
            _escaped(F.col("text")),
            F.lit("</b></figcaption></figure></div>"),
        ).alias("html"),
    ).withColumn("doc_id", F.concat_ws("-", "conv_id", "turn"))
    return markup.page_figures(pages).select(
        "doc_id", "ord", "image_path", "caption", "width", "height"
    )


# --- normalization -----------------------------------------------------------


@query
def normalize_blocks(spark, sf_dir):
    """Missing pages, texts and headings take their defaults."""
    b = B.raw_blocks(spark, sf_dir)
    long = F.length("text") > 40
    raw = b.select(
        "doc_id",
        "ord",
        F.when(F.col("page") > 1, F.col("page")).alias("page"),
        F.when(long, F.col("text")).alias("text"),
        F.when(long, F.array(F.lit("head"))).alias("headings"),
        F.when(long, F.array(F.col("page"), F.lit(0), F.lit(1), F.lit(2))).alias("bbox"),
    )
    n = normalize.normalize_blocks(raw, dense=True)
    return n.select(
        "doc_id",
        "id",
        "type",
        "page",
        joined(F.transform("bbox", lambda x: x.cast("string")), ",").alias("bbox"),
        "text",
        "enriched_text",
        joined("headings").alias("headings"),
        "heading_level",
    )


@query
def normalize_tables(spark, sf_dir):
    t = tables(spark, sf_dir)
    return t.select(
        "doc_id",
        "id",
        "page",
        "caption",
        joined("tags").alias("tags"),
        F.size("grid").alias("n_rows"),
        F.md5(joined(F.transform("grid", lambda r: joined(r, " ")), "\n")).alias("grid_md5"),
        "markdown_path",
        "csv_path",
        "json_path",
    )


@query
def normalize_figures(spark, sf_dir):
    """Turns numbered within their conversation."""
    n = normalize.normalize_figures(B.talk_figures(spark, sf_dir), vocabulary=B.CORPUS_TAGS)
    return n.select(
        "doc_id",
        "figure_id",
        "page",
        "caption",
        joined("tags").alias("tags"),
        "image_path",
        "width",
        "height",
        joined(F.transform("bbox", lambda x: x.cast("string")), ",").alias("bbox"),
    )


@query
def assign_ids(spark, sf_dir):
    """Events numbered within their user, by the segmented scan."""
    events = B.table(spark, sf_dir, "events").select("user_id", "event_id")
    return normalize.assign_ids(events, "evt", keys=["user_id"], order="event_id")


@query
def first_and_min_page(spark, sf_dir):
    """Provenance lists made of line lengths, with unknown entries."""
    known = F.transform(
        B.lines(F.col("text")), lambda x: F.when(F.length(x) > 80, F.length(x))
    )
    return documents(spark, sf_dir).select(
        "doc_id",
        normalize.first_page(known).alias("first_page"),
        normalize.min_page(known).alias("min_page"),
    )


@query
def resolve_caption(spark, sf_dir):
    """Every line as a caption: its own text, else the source, else nothing."""
    each = documents(spark, sf_dir).select("doc_id", "source", F.posexplode(B.lines(F.col("text"))).alias("line", "own"))
    return each.select(
        "doc_id",
        "line",
        normalize.resolve_caption(
            F.when(F.length("own") > 60, F.col("own")).otherwise(""),
            F.when(F.length("own") > 30, F.col("source")),
        ).alias("caption"),
    )


@query
def new_status(spark, sf_dir):
    s = triage.new_status(B.figures(spark, sf_dir), model=B.MODEL)
    return s.withColumn("external_llm_result", F.to_json("external_llm_result")).withColumn(
        "processed_at", F.coalesce(F.col("processed_at").cast("string"), F.lit(""))
    )


# --- filters -----------------------------------------------------------------


@query
def filter_pages(spark, sf_dir):
    return filters.filter_pages(B.raw_blocks(spark, sf_dir), SPEC).select(
        "doc_id", "ord", "page", "text"
    )


@query
def filter_pages_by_spec(spark, sf_dir):
    """Labels decide the spec; documents without a label, or with only a reversed range, pass whole."""
    spec = (
        F.when(F.col("toxic") == 1, "5-3")
        .when(F.col("quality") == 1, "1-2, 4,")
        .otherwise("5-3,2")
    )
    specs = B.table(spark, sf_dir, "labels").select("doc_id", spec.alias("spec"))
    return filters.filter_pages_by_spec(B.raw_blocks(spark, sf_dir), specs).select(
        "doc_id", "ord", "page", "text"
    )


@query
def limit_per_document(spark, sf_dir):
    """The first three figures of each document: the cap is the feature."""
    return filters.limit_per_document(B.figures(spark, sf_dir), 3).select(
        "doc_id", "figure_id", "caption"
    )


@query
def drop_imageless(spark, sf_dir):
    return normalize.drop_imageless(B.talk_figures(spark, sf_dir)).select(
        "doc_id", "figure_id", "image_path"
    )


@query
def noise_figures(spark, sf_dir):
    f = B.figures(spark, sf_dir)
    return f.where(triage.is_noise(F.col("width"), F.col("height"))).select(
        "doc_id", "figure_id", "width", "height"
    )


@query
def valid_descriptions(spark, sf_dir):
    """Whole documents, their lines and all conversation turns."""
    d = documents(spark, sf_dir)
    whole = d.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("pos"), "text")
    line = B.raw_blocks(spark, sf_dir).select(F.lit("line").alias("kind"), F.col("doc_id").alias("id"), F.col("ord").alias("pos"), "text")
    talk = B.table(spark, sf_dir, "conversations").select(
        F.lit("turn").alias("kind"), F.col("conv_id").alias("id"), F.col("turn").alias("pos"), "text"
    )
    return whole.unionByName(line).unionByName(talk).select(
        "kind", "id", "pos", T.is_valid_description("text").alias("valid")
    )


# --- chunking ----------------------------------------------------------------


@query
def heading_path(spark, sf_dir):
    return headed(spark, sf_dir).select(
        "doc_id", "ord", "section", joined("headings", "\n").alias("headings")
    )


@query
def enriched_text(spark, sf_dir):
    return headed(spark, sf_dir).select(
        "doc_id",
        "ord",
        chunking.contextualize(F.col("headings"), F.col("text")).alias("enriched_text"),
    )


def _chunks(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id",
        "section",
        "chunk",
        "page",
        "first_ord",
        "n_tokens",
        joined("headings", "\n").alias("headings"),
        "text",
    )


@query
def chunk_tokens(spark, sf_dir):
    return _chunks(chunking.chunk_tokens(headed(spark, sf_dir), CHUNK))


@query
def chunk_greedy(spark, sf_dir):
    return _chunks(chunking.chunk_greedy(headed(spark, sf_dir), CHUNK))


# --- classification ----------------------------------------------------------


def _verdicts(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id",
        "ord",
        F.col("classification.type").alias("type"),
        F.col("classification.confidence").alias("confidence"),
        F.col("classification.rationale").alias("rationale"),
    )


@query
def classify_by_rules(spark, sf_dir):
    """Each line as a caption with the next one as context, rules as a CASE chain."""
    f = B.raw_figures(spark, sf_dir)
    return _verdicts(R.classify(f, F.col("caption"), F.col("reply"), B.CORPUS_FIGURE_RULES))


def _by_table(spark: SparkSession, sf_dir: str, rules: DataFrame) -> DataFrame:
    f = B.raw_figures(spark, sf_dir)
    return _verdicts(
        rule_index.classify_by_rule_table(f, rules, ["doc_id", "ord"], F.col("caption"), F.col("reply"))
    )


@query
def classify_by_rule_table(spark, sf_dir):
    """The same with the rules as a table."""
    rows = rule_index.rule_rows(B.CORPUS_FIGURE_RULES)
    return _by_table(spark, sf_dir, spark.createDataFrame(rows, rule_index.SCHEMA))


@query
def classify_by_many_rules(spark, sf_dir):
    """A rule table that grows with the tables: the names of parts, and what benchmark items begin with."""
    return _by_table(spark, sf_dir, B.many_rules(spark, sf_dir))


@query
def classify_figures_by_table(spark, sf_dir):
    """The same rules over captions and the text of the same page."""
    raw = B.raw_figures(spark, sf_dir).drop("reply")
    figures = normalize.normalize_figures(raw, dense=True, vocabulary=B.CORPUS_TAGS)
    ruled = context.classify_figures_by_table(figures, B.raw_blocks(spark, sf_dir), B.many_rules(spark, sf_dir))
    return ruled.select(
        "doc_id", "figure_id", F.col("classification.type").alias("type"),
        F.col("classification.rationale").alias("rationale"),
    )


@query
def classify_default_rules(spark, sf_dir):
    """The built-in rules over whole documents."""
    d = documents(spark, sf_dir).withColumn("ord", F.lit(1))
    return _verdicts(R.classify(d, F.col("source"), F.col("text")))


@query
def extract_tags(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.select(
        "doc_id",
        joined(R.tags(F.col("text"), F.col("source"), vocabulary=B.CORPUS_TAGS)).alias("tags"),
        joined(R.tags(F.col("text"))).alias("default_tags"),
    )


@query
def infer_class(spark, sf_dir):
    """Corpus rules and built-in rules on every line."""
    b = R.infer_label(B.raw_blocks(spark, sf_dir), "text", B.CORPUS_DESCRIPTION_RULES)
    return R.infer_label(b, "text", out="default_label").select(
        "doc_id", "ord", "label", "default_label"
    )


@query
def route_local(spark, sf_dir):
    b = R.infer_label(B.raw_blocks(spark, sf_dir), "text", B.CORPUS_DESCRIPTION_RULES)
    return b.select(
        "doc_id",
        "ord",
        triage.is_resolved_locally(F.col("label"), F.col("text")).alias("resolved"),
    )


@query
def page_context(spark, sf_dir):
    return context.page_context(B.raw_blocks(spark, sf_dir)).select("doc_id", "page", "context")


@query
def classify_figures(spark, sf_dir):
    """Caption and same-page text together decide."""
    return flat_figures(ruled_figures(spark, sf_dir)).select(
        "doc_id", "figure_id", "type", "class_confidence", "rationale"
    )


@query
def baseline_description(spark, sf_dir):
    return flat_figures(ruled_figures(spark, sf_dir)).select(
        "doc_id", "figure_id", "description", "description_confidence", "notes"
    )


def _flat_statuses(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id",
        "figure_id",
        "image_path",
        "status",
        "stage",
        "local_llm_provider",
        "local_llm_model",
        "local_llm_description",
        "local_llm_classification",
        "needs_external",
        "confidence",
    )


@query
def triage_figures(spark, sf_dir):
    return _flat_statuses(statuses(spark, sf_dir))


@query
def triage_conversations(spark, sf_dir):
    """Turns as figures with gaps, each answered by the turn after it; no earlier statuses."""
    numbered = normalize.assign_ids(B.talk_figures(spark, sf_dir), "fig", out="figure_id")
    replies = numbered.select("doc_id", "ord", "figure_id").join(
        B.talk_responses(spark, sf_dir), ["doc_id", "ord"]
    )
    return _flat_statuses(
        triage.triage(
            numbered,
            replies,
            model=B.MODEL,
            now=F.lit(B.RUN_STAMP),
            rules=B.CORPUS_DESCRIPTION_RULES,
        )
    )


@query
def describe_then_triage(spark, sf_dir):
    """The model hook with a deterministic stand-in for the model."""

    def load_model():
        def reply(prompt: str, paths: list[str]) -> list[str]:
            if not all(paths):
                raise ValueError("no image")
            return [f"  A board seen at {path} in this picture  " for path in paths]

        return reply

    raw = normalize.assign_ids(B.talk_figures(spark, sf_dir), "fig", out="figure_id")
    responses = describe.settled_responses(raw, load_model)
    done = triage.triage(raw, responses, now=F.lit(B.RUN_STAMP))
    return done.select(
        "doc_id",
        "figure_id",
        "status",
        "stage",
        "local_llm_description",
        "local_llm_classification",
        "confidence",
    )


@query
def recommend_action(spark, sf_dir):
    f = folded_figures(spark, sf_dir)
    advice = report.recommend_action(
        F.col("classification.type"), F.col("derived.description.notes")
    )
    return f.select("doc_id", "figure_id", advice.alias("a")).select(
        "doc_id",
        "figure_id",
        "a.action",
        "a.reason",
        "a.confidence",
    )


@query
def report_entries(spark, sf_dir):
    e = entries(spark, sf_dir)
    return e.select(
        "doc_id",
        "figure_id",
        "page",
        "caption",
        joined("tags").alias("tags"),
        "image_path",
        F.col("classification.type").alias("type"),
        F.col("classification.confidence").alias("class_confidence"),
        F.col("classification.rationale").alias("rationale"),
        "recommended_manual_action",
        "reason",
        "confidence",
    )


# --- joins -------------------------------------------------------------------


@query
def fold_statuses(spark, sf_dir):
    return flat_figures(folded_figures(spark, sf_dir))


@query
def orphan_artifacts(spark, sf_dir):
    """One image per block exists; those that no pictured figure of the document names are orphans."""
    artifacts = B.raw_blocks(spark, sf_dir).select(
        "doc_id", F.format_string("out/%d/figures/%d.png", "doc_id", "ord").alias("path")
    )
    return lifecycle.orphans(artifacts, B.figures(spark, sf_dir))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second figures of labelled documents: those analysed so far."""
    return B.table(spark, sf_dir, "labels").select("doc_id", F.lit("fig_0002").alias("figure_id"))


@query
def external_queue(spark, sf_dir):
    return lifecycle.external_queue(
        B.figures(spark, sf_dir).select("doc_id", "figure_id", "image_path"),
        latest_log(spark, sf_dir),
        _labelled(spark, sf_dir),
    )


@query
def restrict_to_ids(spark, sf_dir):
    return lifecycle.restrict_to(
        B.figures(spark, sf_dir), _labelled(spark, sf_dir)
    ).select("doc_id", "figure_id", "caption")


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analyses of second and third figures of labelled documents, the later one valid."""
    labels = B.table(spark, sf_dir, "labels")
    versions = labels.select(
        "doc_id",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(f).alias("figure_id"), F.lit(v).alias("version"))
                    for f, v in (("fig_0002", 1), ("fig_0002", 2), ("fig_0003", 1))
                ]
            )
        ).alias("v"),
        "quality",
    ).select("doc_id", "v.*", "quality")
    analysed = versions.select(
        "doc_id",
        "figure_id",
        "version",
        F.to_variant_object(F.struct("quality", "version")).alias("result"),
        F.when(F.col("quality") == 1, "provider-a").alias("provider"),
        F.format_string("model-%d", "version").alias("model"),
    )
    return lifecycle.latest(analysed, ["doc_id", "figure_id"], ["version"])


def applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.apply_external(statuses(spark, sf_dir), _results(spark, sf_dir))


@query
def apply_external(spark, sf_dir):
    result = F.variant_get("external_llm_result", "$.version", "int")
    return applied(spark, sf_dir).select(
        "doc_id",
        "figure_id",
        "status",
        "needs_external",
        "external_llm_provider",
        "external_llm_model",
        result.alias("version"),
    )


@query
def audit_consistency(spark, sf_dir):
    """Report before the fold of half-known statuses against the final statuses."""
    done = settle(statuses(spark, sf_dir), "statuses")
    folded = lifecycle.fold_statuses(ruled_figures(spark, sf_dir), done)
    return lifecycle.audit_consistency(report.report_entries(folded), done).select("doc_id", "figure_id", "report_class", "status_class", "action", "status", "issue")


@query
def audit_unfolded(spark, sf_dir):
    """The same against rule-only figures: here classes do differ."""
    unfolded = report.report_entries(ruled_figures(spark, sf_dir))
    return lifecycle.audit_consistency(unfolded, statuses(spark, sf_dir)).select(
        "doc_id", "figure_id", "report_class", "status_class", "action", "status", "issue"
    )


# --- aggregates --------------------------------------------------------------


@query
def doc_stats(spark, sf_dir):
    """Counts after a page filter; the page count is that of the whole document."""
    blocks = B.raw_blocks(spark, sf_dir)
    seen = documents(spark, sf_dir).select(
        "doc_id",
        normalize.page_count(
            F.lit(None).cast("bigint"),
            F.ceil(F.size(B.lines(F.col("text"))) / F.lit(B.BLOCKS_PER_PAGE)),
        ).alias("page_count"),
    )
    return rollup.doc_stats(
        seen,
        filters.filter_pages(blocks, "2-4"),
        filters.filter_pages(tables(spark, sf_dir), "2-4"),
        filters.filter_pages(B.figures(spark, sf_dir), "2-4").where(
            F.col("image_path").isNotNull()
        ),
    )


@query
def status_rollup(spark, sf_dir):
    """Flagship: how complete is each document after triage?"""
    return rollup.rollup_by_document(statuses(spark, sf_dir), documents(spark, sf_dir))


def _long_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_global", F.col("is_global").cast("bigint"))


@query
def status_rollup_global(spark, sf_dir):
    return _long_flag(rollup.rollup_global(latest_log(spark, sf_dir)))


@query
def rollup_after_external(spark, sf_dir):
    return _long_flag(rollup.rollup_global(applied(spark, sf_dir)))


@query
def rollup_detail(spark, sf_dir):
    return rollup.rollup_detail(statuses(spark, sf_dir))


@query
def class_breakdown(spark, sf_dir):
    return rollup.class_breakdown(statuses(spark, sf_dir), B.analyses(spark, sf_dir))


@query
def class_breakdown_wide(spark, sf_dir):
    return rollup.class_breakdown_wide(statuses(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pictured = B.figures(spark, sf_dir).where(F.col("image_path").isNotNull())
    return export.artifact_index(manifest(spark, sf_dir), tables(spark, sf_dir), pictured)


@query
def smoke_checks(spark, sf_dir):
    """Labelled documents lost artifacts: index when toxic, document when of low quality."""
    stats = rollup.doc_stats(
        documents(spark, sf_dir).select("doc_id", B.pages_of(F.col("text")).alias("page_count")),
        B.raw_blocks(spark, sf_dir),
        figures=B.figures(spark, sf_dir),
    )
    labels = B.table(spark, sf_dir, "labels")
    have = documents(spark, sf_dir).select("doc_id").join(labels, "doc_id", "left")
    kept = have.select(
        "doc_id",
        F.explode(
            F.filter(
                F.array(
                    F.when(F.coalesce(F.col("quality") == 1, F.lit(True)), "document"),
                    F.when(F.coalesce(F.col("toxic") == 0, F.lit(True)), "index"),
                ),
                lambda k: k.isNotNull(),
            )
        ).alias("kind"),
    )
    images = (
        B.figures(spark, sf_dir)
        .where("image_path is not null")
        .select("doc_id", F.lit("figure").alias("kind"))
    )
    return rollup.smoke_checks(documents(spark, sf_dir), stats, kept.unionByName(images))


@query
def latest_status(spark, sf_dir):
    return latest_log(spark, sf_dir).select(
        "doc_id", "figure_id", "event_id", "status", "local_llm_classification"
    )


@query
def all_items(spark, sf_dir):
    b = normalize.normalize_blocks(B.raw_blocks(spark, sf_dir), dense=True)
    f = B.figures(spark, sf_dir).withColumnRenamed("figure_id", "id")
    return rollup.all_items(block=b, table=tables(spark, sf_dir), figure=f)


# --- exports -----------------------------------------------------------------


def assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = normalize.normalize_blocks(B.raw_blocks(spark, sf_dir), dense=True)
    tabs = tables(spark, sf_dir)
    figs = ruled_figures(spark, sf_dir).withColumnRenamed("figure_id", "id")
    seen = documents(spark, sf_dir).select("doc_id", F.lit(1).alias("page_count"))
    stats = rollup.doc_stats(seen, blocks, tabs, figs)
    docs = manifest(spark, sf_dir).join(stats, "doc_id").select(
        "doc_id",
        F.struct("path", "sha256", "size", "mtime").alias("source"),
        F.struct("page_count", "block_count", "table_count", "figure_count").alias("doc_stats"),
    )
    return export.assemble_documents(docs, blocks, tabs, figs)


@query
def assemble_documents(spark, sf_dir):
    """Nested records, checked through digests of their children."""
    a = assembled(spark, sf_dir)

    def texts(array: str, field: str, sep: str) -> Column:
        return F.md5(F.array_join(F.transform(array, lambda x: x[field]), sep))

    return a.select(
        "doc_id",
        "part",
        F.col("source.sha256").alias("sha256"),
        F.col("doc_stats.block_count").alias("block_count"),
        F.size("blocks").alias("n_blocks"),
        F.size("tables").alias("n_tables"),
        F.size("figures").alias("n_figures"),
        F.get("blocks", F.lit(0))["id"].alias("first_block"),
        F.element_at("figures", -1)["id"].alias("last_figure"),
        texts("blocks", "text", "\n").alias("blocks_md5"),
        texts("figures", "caption", "\n").alias("figures_md5"),
    )


def enriched(docs: DataFrame, existing: DataFrame, home: corpus.Home) -> corpus.Corpus:
    """The whole path over some documents."""
    raw = B.raw_figures_of(docs)
    return corpus.enrich(
        docs.select(
            "doc_id",
            F.concat_ws("/", "source", F.format_string("%d.txt", "doc_id")).alias("path"),
            F.ceil(F.size(B.lines(F.col("text"))) / F.lit(B.BLOCKS_PER_PAGE)).alias("page_count"),
        ),
        B.items_of(docs),
        B.raw_tables_of(docs),
        raw.drop("reply"),
        B.responses_of(raw),
        existing,
        options=corpus.Options(
            model=B.MODEL,
            max_tokens=CHUNK,
            figure_rules=B.CORPUS_FIGURE_RULES,
            description_rules=B.CORPUS_DESCRIPTION_RULES,
            tags=B.CORPUS_TAGS,
        ),
        now=F.lit(B.RUN_STAMP),
        home=home,
    )


def corpus_run(spark: SparkSession, sf_dir: str) -> str:
    """The whole path over all documents, stored; returns the folder of the run."""
    path = scratch(spark, "corpus")
    with passing(spark):
        whole = enriched(documents(spark, sf_dir), B.existing_statuses(spark, sf_dir), corpus.Home(path, 1))
        corpus.write(whole, path, 1)
    return path


@query
def corpus_documents(spark, sf_dir):
    """Stored nested documents of a whole run, checked through digests of their children."""
    records = runs.read_runs(spark, f"{corpus_run(spark, sf_dir)}/documents")
    stored = export.from_records(
        records,
        "blocks ARRAY<STRUCT<text: STRING>>, tables ARRAY<STRUCT<id: STRING>>, figures ARRAY<STRUCT<id: STRING>>",
    )
    return stored.select(
        "doc_id",
        "part",
        F.size("blocks").alias("n_blocks"),
        F.size("tables").alias("n_tables"),
        F.size("figures").alias("n_figures"),
        F.md5(F.array_join(F.transform("blocks", lambda x: x["text"]), "\n")).alias("blocks_md5"),
        F.md5(F.array_join(F.transform("figures", lambda x: x["id"]), "\n")).alias("figures_md5"),
    )


@query
def corpus_stats(spark, sf_dir):
    return runs.read_runs(spark, f"{corpus_run(spark, sf_dir)}/doc_stats")


@query
def corpus_report(spark, sf_dir):
    return _stored_report(spark, corpus_run(spark, sf_dir))


def _stored_report(spark: SparkSession, path: str) -> DataFrame:
    stored = runs.read_runs(spark, f"{path}/report")
    return stored.select(
        "doc_id",
        "figure_id",
        "page",
        F.col("classification.type").alias("type"),
        F.col("classification.confidence").alias("class_confidence"),
        "recommended_manual_action",
        "reason",
    )


@query
def corpus_rollup(spark, sf_dir):
    stored = runs.read_runs(spark, f"{corpus_run(spark, sf_dir)}/rollup")
    return stored.where("total_figures > 0")


@query
def artifact_index(spark, sf_dir):
    return _index(spark, sf_dir)


@query
def index_records(spark, sf_dir):
    r = export.index_records(_index(spark, sf_dir))
    return r.select(
        "doc_id",
        "part",
        "document_json",
        joined("figures").alias("figures"),
        joined("tables").alias("tables"),
    )


@query
def table_to_json(spark, sf_dir):
    """The JSON read back: its grid must be the document's own words."""
    j = export.table_to_json(tables(spark, sf_dir))
    back = F.from_json("json", "id string, grid array<array<string>>, caption string")
    return j.select("doc_id", back.alias("b")).select(
        "doc_id",
        F.col("b.id").alias("id"),
        F.col("b.caption").alias("caption"),
        F.md5(joined(F.transform("b.grid", lambda r: joined(r, " ")), "\n")).alias("grid_md5"),
    )


@query
def table_to_csv(spark, sf_dir):
    return export.table_to_csv(tables(spark, sf_dir))


@query
def table_to_markdown(spark, sf_dir):
    return export.table_to_markdown(tables(spark, sf_dir))


@query
def table_cells_long(spark, sf_dir):
    return export.table_cells_long(tables(spark, sf_dir))


def _numbered_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each user's table; row 0 acts as its header."""
    rows = number_rows(B.event_rows(spark, sf_dir), ["doc_id"], "ord", out="n")
    return rows.withColumn("row", F.col("n") - 1)


@query
def table_rows_to_csv(spark, sf_dir):
    return export.rows_to_csv(_numbered_event_rows(spark, sf_dir))


@query
def table_rows_to_markdown(spark, sf_dir):
    return export.rows_to_markdown(_numbered_event_rows(spark, sf_dir))


@query
def figure_markdown(spark, sf_dir):
    m = report.figure_markdown(folded_figures(spark, sf_dir))
    meta = F.col("meta_json")
    return m.select(
        "doc_id",
        "figure_id",
        "description_md",
        F.get_json_object(meta, "$.figure.id").alias("meta_id"),
        F.get_json_object(meta, "$.figure.caption").alias("meta_caption"),
        F.get_json_object(meta, "$.figure.classification.type").alias("meta_type"),
    )


@query
def report_markdown(spark, sf_dir):
    return report.report_markdown(settle(entries(spark, sf_dir), "entries"), documents(spark, sf_dir))


@query
def global_report_markdown(spark, sf_dir):
    return report.global_report_markdown(entries(spark, sf_dir))


@query
def rollup_markdown(spark, sf_dir):
    return report.rollup_markdown(applied(spark, sf_dir), documents(spark, sf_dir))


@query
def rollup_markdown_text(spark, sf_dir):
    """The same joined to texts."""
    lines = report.rollup_markdown(latest_log(spark, sf_dir))
    return report.markdown_parts(lines).select("doc_id", "section", "part", "text")


# --- scalar functions --------------------------------------------------------


@query
def csv_escape(spark, sf_dir):
    e = B.table(spark, sf_dir, "events")
    return e.select("event_id", G.csv_escape(F.col("props")).alias("cell"))


@query
def text_counts(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.select(
        "doc_id",
        T.printable_count("text").alias("printable"),
        T.letter_count("text").alias("letters"),
        T.is_blank("text").alias("blank"),
        F.length(T.strip(F.concat(F.lit(" \t"), F.col("text"), F.lit("\n ")))).alias("stripped"),
    )


@query
def percent_complete(spark, sf_dir):
    """Share of each user's events that are errors."""
    e = B.table(spark, sf_dir, "events")
    return (
        e.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("done"))
        .select("user_id", T.percent(F.col("done"), F.col("n")).alias("percent"))
    )


# --- analyses ----------------------------------------------------------------


@query
def analysis_flat(spark, sf_dir):
    return analysis.flatten_analysis(B.analyses(spark, sf_dir))


@query
def plot_points(spark, sf_dir):
    return analysis.plot_points(B.analyses(spark, sf_dir))


@query
def plot_csv_long(spark, sf_dir):
    return analysis.plot_csv_long(B.analyses(spark, sf_dir))


@query
def component_index(spark, sf_dir):
    return analysis.component_index(B.analyses(spark, sf_dir))


@query
def component_counts(spark, sf_dir):
    return analysis.component_counts(B.analyses(spark, sf_dir))


@query
def key_values_long(spark, sf_dir):
    """Key values of events, whose properties are JSON objects."""
    e = B.table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "map<string,string>").alias("key_values")
    )
    return analysis.key_values_long(e, ["event_id"])


@query
def analysis_key_values(spark, sf_dir):
    return analysis.key_values_long(B.analyses(spark, sf_dir))


@query
def diagram_edges(spark, sf_dir):
    return analysis.edges(B.analyses(spark, sf_dir))


@query
def pin_table(spark, sf_dir):
    return analysis.pin_table(B.analyses(spark, sf_dir))


@query
def register_bits(spark, sf_dir):
    return analysis.register_bits(B.analyses(spark, sf_dir))


@query
def schematic_components(spark, sf_dir):
    return analysis.schematic_components(B.analyses(spark, sf_dir))


@query
def signal_table(spark, sf_dir):
    return analysis.signal_table(B.analyses(spark, sf_dir))


@query
def image_table_grid(spark, sf_dir):
    """Image tables through the CSV export."""
    grids = analysis.image_table_grid(B.analyses(spark, sf_dir))
    return grids.select("doc_id", "id", "caption", G.grid_to_csv(F.col("grid")).alias("csv"))


@query
def analysis_quality(spark, sf_dir):
    return analysis.analysis_quality(B.analyses(spark, sf_dir))


@query
def schema_drift(spark, sf_dir):
    return analysis.schema_drift(B.analyses(spark, sf_dir))


# --- streaming ---------------------------------------------------------------


def _stream_of(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """A table that may be one file or a folder of parts, as a path for a stream, and its schema."""
    return f"{sf_dir}/{name}.parquet*", B.table(spark, sf_dir, name).schema


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.read_stream(spark, *_stream_of(spark, sf_dir, "events"))


@query
def stream_classify(spark, sf_dir):
    """Documents arriving as a stream, classified by the batch expression."""
    configure(spark)
    stream = jobs.read_stream(spark, *_stream_of(spark, sf_dir, "documents"))
    home = scratch(spark, "stream-classify")
    jobs.run_to_table(
        _verdicts(
            R.classify(
                stream.withColumn("ord", F.lit(1)),
                F.col("source"),
                F.col("text"),
                B.CORPUS_FIGURE_RULES,
            )
        ),
        f"{home}/out",
        f"{home}/checkpoint",
    )
    return spark.read.parquet(f"{home}/out")


@query
def stream_corpus(spark, sf_dir):
    """The whole path over documents that arrive: the stored report."""
    configure(spark)
    home = scratch(spark, "stream-corpus")
    stream = jobs.read_stream(spark, *_stream_of(spark, sf_dir, "documents"))
    existing = B.existing_statuses(spark, sf_dir)
    jobs.corpus_stream(
        stream, f"{home}/checkpoint", f"{home}/out", lambda docs, run: enriched(docs, existing, run), homed=True
    )
    return _stored_report(spark, f"{home}/out")


@query
def stream_latest_status(spark, sf_dir):
    configure(spark)
    home = scratch(spark, "stream-latest")
    key = ("doc_id", "figure_id")
    log = B.as_status_log(_event_stream(spark, sf_dir))
    jobs.upsert_to_runs(
        jobs.latest_stream(log, key, ["processed_at", "event_id"]),
        f"{home}/out",
        f"{home}/checkpoint",
        key,
    )
    return runs.read_runs(spark, f"{home}/out", key).select(
        "doc_id", "figure_id", "event_id", "status", "local_llm_classification"
    )


@query
def stream_daily_rollup(spark, sf_dir):
    configure(spark)
    home = scratch(spark, "stream-rollup")
    log = B.as_status_log(_event_stream(spark, sf_dir))
    jobs.run_to_table(jobs.rollup_stream(log), f"{home}/out", f"{home}/checkpoint")
    out = spark.read.parquet(f"{home}/out")
    return out.withColumn("day", F.date_format("window_start", "yyyy-MM-dd")).drop(
        "window_start", "window_end"
    )


@query
def stream_live_rollup(spark, sf_dir):
    """Newest statuses by day, kept up as the log arrives: no window waits, nothing late is lost."""
    configure(spark)
    home = scratch(spark, "stream-live")
    log = B.as_status_log(_event_stream(spark, sf_dir))
    jobs.run_to_table(jobs.status_changes(log), f"{home}/out", f"{home}/checkpoint")
    day = F.date_format("processed_at", "yyyy-MM-dd").alias("day")
    return rollup.rollup_of_changes(spark.read.parquet(f"{home}/out"), day)


@query
def stream_dedupe(spark, sf_dir):
    """Each event arrives twice and is kept once."""
    configure(spark)
    home = scratch(spark, "stream-dedupe")
    log = B.as_status_log(_event_stream(spark, sf_dir))
    twice = log.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    jobs.run_to_table(
        jobs.dedupe_stream(twice, ["event_id"]), f"{home}/out", f"{home}/checkpoint"
    )
    return spark.read.parquet(f"{home}/out").select("doc_id", "figure_id", "event_id", "status")


# --- sinks -------------------------------------------------------------------


@query
def rerun_documents(spark, sf_dir):
    """Two runs of block counts: the second covers labelled documents and finds only long lines there."""
    configure(spark)
    home = scratch(spark, "runs")
    blocks = B.raw_blocks(spark, sf_dir)
    docs = documents(spark, sf_dir)
    labels = B.table(spark, sf_dir, "labels")
    runs.write_run(blocks, docs, home, 1)
    again = blocks.join(labels.select("doc_id"), "doc_id", "left_semi").where(
        F.length("text") > 200
    )
    runs.write_run(again, labels, home, 2)
    return (
        runs.read_runs(spark, home)
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("blocks"), F.sum(F.length("text")).alias("chars"))
    )


@query
def status_files_round_trip(spark, sf_dir):
    """Statuses stored, those with an external result upserted, and all read back."""
    configure(spark)
    home = scratch(spark, "statuses")
    sink.write_statuses(statuses(spark, sf_dir), home, 1)
    sink.store_analyses(_results(spark, sf_dir), home, 2)
    result = F.variant_get("external_llm_result", "$.version", "int")
    return files.read_statuses(spark, home).select(
        "doc_id", "figure_id", "status", "confidence", "local_llm_description", result.alias("version")
    )


@query
def status_store(spark, sf_dir):
    """The status log put into the store week by week, some figures removed, runs merged, and read back."""
    configure(spark)
    home = scratch(spark, "status-store")
    log = settle(B.status_log(spark, sf_dir).withColumn("week", F.date_trunc("week", "processed_at")), "log")
    weeks = [r.week for r in log.select("week").distinct().orderBy("week").collect()]
    blank = triage.new_status(log.select("doc_id", "figure_id", "image_path")).limit(0)
    for n, week in enumerate(weeks):
        newest = lifecycle.latest(log.where(F.col("week") == week), ["doc_id", "figure_id"], ["processed_at", "event_id"])
        records = blank.unionByName(newest.drop("event_id", "week"), allowMissingColumns=True)
        sink.write_statuses(records, home, n)
        runs.merge_runs(spark, home, 2)
    gone = log.where("local_llm_classification = 'error'").select("doc_id", "figure_id")
    sink.remove_statuses(gone, home, len(weeks))
    return files.read_statuses(spark, home).select("doc_id", "figure_id", "status", "local_llm_classification")


@query
def source_changes(spark, sf_dir):
    """Documents against an earlier state: labelled ones differ by label, benchmark items are gone."""
    now = manifest(spark, sf_dir)
    labels = B.table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    before = (
        now.join(labels, "doc_id", "left")
        .where("quality is null or quality = 1")  # documents of low quality are new
        .withColumn("sha256", F.when(F.col("toxic") == 1, F.reverse("sha256")).otherwise(F.col("sha256")))
        .withColumn("mtime", F.when(F.col("toxic") == 0, F.lit(B.RUN_STAMP).cast("timestamp")))
        .select("path", "sha256", "mtime")
    )
    gone = B.table(spark, sf_dir, "benchmark").select(
        F.format_string("gone/%d.txt", "item_id").alias("path"),
        F.sha2("text", 256).alias("sha256"),
        F.lit(None).cast("timestamp").alias("mtime"),
    )
    return files.source_changes(now, before.unionByName(gone))

"""Structure of HTML pages held in a table: blocks, tables and figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions import markup as M


def page_items(pages: DataFrame, *, doc: str = "doc_id", html: str = "html") -> DataFrame:
    """(doc_id, ord, page, tag, text, level): visible text in order, headings with their level.

    Narrow: one page is cut inside its own row.
    """
    cut = pages.select(
        F.col(doc).alias("doc_id"), F.posexplode(M.pieces(F.col(html))).alias("pos", "x")
    )
    tag = F.col("x.tag")
    return cut.select(
        "doc_id",
        (F.col("pos") + 1).cast("bigint").alias("ord"),
        F.lit(1).alias("page"),
        tag.alias("tag"),
        F.col("x.text").alias("text"),
        F.when(tag.rlike("^h[1-6]$"), F.substring(tag, 2, 1).cast("int")).alias("level"),
    )


def page_tables(pages: DataFrame, *, doc: str = "doc_id", html: str = "html") -> DataFrame:
    """(doc_id, ord, page, caption, header, rows): one raw table per table element."""
    cut = pages.select(
        F.col(doc).alias("doc_id"), F.posexplode(M.tables(F.col(html))).alias("pos", "x")
    ).select("doc_id", "pos", "x.caption", "x.grid")
    return cut.select(
        "doc_id",
        (F.col("pos") + 1).cast("bigint").alias("ord"),
        F.lit(1).alias("page"),
        "caption",
        F.get("grid", F.lit(0)).alias("header"),
        F.slice("grid", F.lit(2), F.greatest(F.size("grid") - 1, F.lit(0))).alias("rows"),
    )


def _figures(pages: DataFrame, doc: str, found) -> DataFrame:
    cut = pages.select(F.col(doc).alias("doc_id"), F.posexplode(found).alias("pos", "x"))
    return cut.select(
        "doc_id", (F.col("pos") + 1).cast("bigint").alias("ord"), F.lit(1).alias("page"), "x.*"
    )


def page_figures(pages: DataFrame, *, doc: str = "doc_id", html: str = "html") -> DataFrame:
    """(doc_id, ord, page, image_path, caption, width, height): one raw figure per image."""
    return _figures(pages, doc, M.images(F.col(html)))


def page_links_as_figures(
    pages: DataFrame, *, doc: str = "doc_id", html: str = "html"
) -> DataFrame:
    """Links as raw figures: target as path, link text as caption."""
    return _figures(pages, doc, M.links(F.col(html)))


def extract_structure(
    pages: DataFrame, *, doc: str = "doc_id", html: str = "html", images: bool = True, tables: bool = True
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Items, raw tables and raw figures of a table of pages; switched-off branches are None."""
    return (
        page_items(pages, doc=doc, html=html),
        page_tables(pages, doc=doc, html=html) if tables else None,
        page_figures(pages, doc=doc, html=html) if images else None,
    )

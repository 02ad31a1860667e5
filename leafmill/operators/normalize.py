"""Raw extraction rows to normalized blocks, tables and figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import rules as R
from leafmill.functions import text as T
from leafmill.functions.ordered import SEGMENT_WIDTH, number_rows

KEY = ("doc_id",)


def assign_ids(
    df: DataFrame,
    prefix: str,
    *,
    keys: Sequence[str] = KEY,
    order: str = "ord",
    out: str = "id",
    dense: bool = False,
    width: int = SEGMENT_WIDTH,
) -> DataFrame:
    """Add ``prefix_0001``-style ids, numbered within ``keys`` in ``order``.

    With ``dense=True`` the order column already counts 1, 2, 3, ... and the id
    is a narrow projection; otherwise rows are numbered by a segmented scan.
    """
    if dense:
        return df.withColumn(out, T.numbered_id(prefix, order))
    numbered = number_rows(df, keys, order, out="__n", width=width)
    return numbered.withColumn(out, T.numbered_id(prefix, "__n")).drop("__n")


def first_page(pages: Column) -> Column:
    """First known page of a provenance list, else 1."""
    return F.coalesce(F.get(F.filter(pages, lambda p: p.isNotNull()), F.lit(0)), F.lit(1))


def min_page(pages: Column) -> Column:
    """Smallest page of a provenance list, else 1."""
    return F.coalesce(F.array_min(pages), F.lit(1))


def resolve_caption(*candidates: Column) -> Column:
    """First candidate that is not null or empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(""))


def page_count(declared: Column, seen: Column) -> Column:
    """Declared number of pages, else the number seen, at least 1."""
    return F.coalesce(declared, F.greatest(seen, F.lit(1)))


def _bbox(df: DataFrame) -> Column:
    zeros = F.array(*[F.lit(0.0)] * 4)
    if "bbox" not in df.columns:
        return zeros
    return F.coalesce(F.transform("bbox", lambda x: x.cast("double")), zeros)


def _text(df: DataFrame, name: str, default: str = "") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(default)) if name in df.columns else F.lit(default)


def _page(df: DataFrame) -> Column:
    return F.coalesce(F.col("page").cast("int"), F.lit(1)) if "page" in df.columns else F.lit(1)


def normalize_blocks(raw: DataFrame, *, dense: bool = False) -> DataFrame:
    """Defaults, casts and ``blk_`` ids; ``ord`` becomes the dense number that the id shows."""
    headings = (
        F.coalesce(F.col("headings"), F.array().cast("array<string>"))
        if "headings" in raw.columns
        else F.array().cast("array<string>")
    )
    return assign_ids(raw, "blk", dense=dense).select(
        "doc_id",
        T.ordinal_of("id").alias("ord"),
        "id",
        _text(raw, "type", "text").alias("type"),
        _page(raw).alias("page"),
        _bbox(raw).alias("bbox"),
        _text(raw, "text").alias("text"),
        _text(raw, "enriched_text").alias("enriched_text"),
        headings.alias("headings"),
        F.lit(None).cast("int").alias("heading_level"),
    )


def build_grid(header: Column, rows: Column) -> Column:
    """Header and body as one grid of strings; no body gives the header alone, neither gives []."""
    empty = F.array().cast("array<array<string>>")
    cells = F.transform(
        F.coalesce(rows, empty),
        lambda r: F.transform(r, lambda c: F.coalesce(c.cast("string"), F.lit(""))),
    )
    head = F.transform(
        F.coalesce(header, F.array().cast("array<string>")),
        lambda c: F.coalesce(c.cast("string"), F.lit("")),
    )
    return F.when(
        (F.size(cells) == 0) & (F.size(head) == 0), empty
    ).otherwise(F.concat(F.array(head), cells))


def normalize_tables(
    raw: DataFrame,
    *,
    dense: bool = False,
    root: str = "out",
    vocabulary: Sequence[str] = R.TAGS,
) -> DataFrame:
    """Grids, tags, ``table_`` ids and artifact paths.  Number first, filter pages afterwards."""
    caption = _text(raw, "caption")
    stem = F.concat_ws("/", F.lit(root), F.col("doc_id").cast("string"), F.lit("tables"), F.col("id"))
    return assign_ids(raw, "table", dense=dense).select(
        "doc_id",
        T.ordinal_of("id").alias("ord"),
        "id",
        _page(raw).alias("page"),
        _bbox(raw).alias("bbox"),
        caption.alias("caption"),
        R.tags(caption, vocabulary=vocabulary).alias("tags"),
        build_grid(F.col("header"), F.col("rows")).alias("grid"),
        F.concat(stem, F.lit(".md")).alias("markdown_path"),
        F.concat(stem, F.lit(".csv")).alias("csv_path"),
        F.concat(stem, F.lit(".json")).alias("json_path"),
    )


def normalize_figures(
    raw: DataFrame, *, dense: bool = False, vocabulary: Sequence[str] = R.TAGS
) -> DataFrame:
    """Defaults and tags; an id that is already there is kept, others are numbered."""
    caption = _text(raw, "caption")
    numbered = assign_ids(raw, "fig", out="__id", dense=dense)
    own = F.col("figure_id") if "figure_id" in raw.columns else F.lit(None).cast("string")
    extra = [c for c in ("width", "height") if c in raw.columns]
    return numbered.select(
        "doc_id",
        "ord",
        F.coalesce(own, F.col("__id")).alias("figure_id"),
        _page(raw).alias("page"),
        _bbox(raw).alias("bbox"),
        caption.alias("caption"),
        R.tags(caption, vocabulary=vocabulary).alias("tags"),
        _text(raw, "image_path").alias("image_path"),
        *extra,
    )


def drop_imageless(raw: DataFrame, *, dense: bool = False) -> DataFrame:
    """Number all pictures, then drop those without an image: the gaps in the ids stay."""
    numbered = assign_ids(raw, "fig", out="figure_id", dense=dense)
    return numbered.where(F.col("image_path").isNotNull())

"""HTML to pieces with boundary splitting; tags are never paired, so unclosed ones do no harm."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_TAGS = (
    "h1|h2|h3|h4|h5|h6|title|p|li|ul|ol|dl|dt|dd|div|nav|article|section|header|footer|main|aside|"
    "table|thead|tbody|tr|td|th|caption|figure|figcaption|blockquote|pre|br|hr|head|body|html"
)
INVISIBLE = (
    r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!doctype[^>]*>"
)
# Marks that stand for structural tags; they are removed from the input first.
MARKS = "\x01\x02\x03\x04\x05\x06\x07"
PIECE, TAG_END, ROW, CELL, CAPTION, CAPTION_END, CELL_END = MARKS
TABLE, TABLE_END = PIECE, TAG_END
REST = 2147483646
# The widest and longest spans that a cell may have.
MOST_COLUMNS, MOST_ROWS = 1000, 65534


def visible(html: Column) -> Column:
    """Markup without comments, scripts, styles and doctype."""
    return F.regexp_replace(F.translate(html, MARKS, ""), INVISIBLE, "")


def _character(code: Column) -> Column:
    """A code point as text; what is no character stays out."""
    real = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    # UTF-32 writes a code point as its number
    wide = F.unhex(F.lpad(F.hex(code), 8, "0"))
    return F.when(real, F.decode(wide, "UTF-32")).otherwise("")


def _numeric(c: Column) -> Column:
    """Decimal and hexadecimal character references decoded, piece by piece after each ``&#``."""
    def decoded(piece: Column, i: Column) -> Column:
        code = F.regexp_extract(piece, r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", 1)
        value = F.when(
            F.lower(F.left(code, F.lit(1))) == "x", F.conv(F.substring(code, 2, 6), 16, 10)
        ).otherwise(code)
        rest = F.substring(piece, F.length(code) + 2, F.length(piece))
        return (
            F.when(i == 0, piece)
            .when(code == "", F.concat(F.lit("&#"), piece))
            .otherwise(F.concat(_character(value.cast("int")), rest))
        )

    return F.array_join(F.transform(F.split(c, "&#"), decoded), "")


def unescape(c: Column) -> Column:
    # The entities that are decoded; the ampersand goes last.
    out = F.when(F.contains(c, F.lit("&#")), _numeric(c)).otherwise(c)
    for entity, char in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&apos;", "'"),
        ("&nbsp;", " "),
        ("&amp;", "&"),
    ):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.when(F.contains(c, F.lit("&")), out).otherwise(c)


def _untagged(marked: Column) -> Column:
    """Remaining tags removed and white space collapsed, in passes over the whole page."""
    no_tags = F.regexp_replace(marked, f"<[^>{MARKS}]*>", "")
    return F.regexp_replace(F.replace(no_tags, F.lit("&nbsp;"), F.lit(" ")), r"\s+", " ")


def _text(c: Column) -> Column:
    return F.trim(unescape(c))


def plain(c: Column) -> Column:
    """Inline tags removed, entities decoded, white space collapsed."""
    return _text(_untagged(c))


def pieces(html: Column) -> Column:
    """Array of (tag, text): what follows each opening or closing block tag, empty text dropped."""
    marked = F.regexp_replace(
        visible(html), rf"(?i)<(/?(?:{BLOCK_TAGS}))\b[^>]*>", f"{PIECE}$1{TAG_END}"
    )
    parsed = F.transform(
        F.split(_untagged(marked), PIECE),
        lambda p: F.struct(
            F.lower(
                F.when(F.contains(p, F.lit(TAG_END)), F.substring_index(p, TAG_END, 1)).otherwise("")
            ).alias("tag"),
            _text(F.substring_index(p, TAG_END, -1)).alias("text"),
        ),
    )
    return F.filter(parsed, lambda x: x["text"] != "")


def tables(html: Column) -> Column:
    """Array of (caption, grid), one per table in order of its opening tag.

    The page is cut at table tags only; a fold over those few cuts tells which table each stretch
    belongs to, so rows and cells of an outer table go on after a nested one.  Cells that span rows or
    columns are repeated in every place they cover.
    """
    marked = visible(html)
    for pattern, mark in (
        (r"<table\b[^>]*>", TABLE),
        (r"</table\s*>", TABLE_END),
        (r"<tr\b[^>]*>", ROW),
        (r"<t[dh]\b([^>]*)>", f"{CELL}$1{CELL_END}"),
        (r"<caption\b[^>]*>", CAPTION),
        (r"</caption\s*>", CAPTION_END),
    ):
        marked = F.regexp_replace(marked, f"(?i){pattern}", mark)
    stretches = F.split(_untagged(marked), f"(?=[{TABLE}{TABLE_END}])")
    none = F.array().cast("array<int>")

    def step(acc: Column, x: Column) -> Column:
        opens = F.startswith(x, F.lit(TABLE))
        stack = (
            F.when(opens, F.concat(acc["stack"], F.array(acc["next"])))
            .when(
                F.startswith(x, F.lit(TABLE_END)),
                F.slice(acc["stack"], F.lit(1), F.greatest(F.size(acc["stack"]) - 1, F.lit(0))),
            )
            .otherwise(acc["stack"])
        )
        owner = F.coalesce(F.try_element_at(stack, F.lit(-1)), F.lit(-1))
        held = F.struct(owner.alias("table"), F.translate(x, TABLE + TABLE_END, "").alias("text"))
        return F.struct(
            stack.alias("stack"),
            (acc["next"] + F.when(opens, 1).otherwise(0)).alias("next"),
            F.concat(acc["held"], F.array(held)).alias("held"),
        )

    begin = F.struct(
        none.alias("stack"),
        F.lit(0).alias("next"),
        F.array().cast("array<struct<table:int,text:string>>").alias("held"),
    )

    def collect(done: Column) -> Column:
        def one(t: Column) -> Column:
            own = F.filter(done["held"], lambda x: x["table"] == t)
            body = F.array_join(F.transform(own, lambda x: x["text"]), "")
            said = F.regexp_extract(body, f"{CAPTION}([^{CAPTION_END}{ROW}]*)", 1)
            rest = F.regexp_replace(body, f"{CAPTION}[^{CAPTION_END}{ROW}]*{CAPTION_END}?", "")
            rows = F.split(F.translate(rest, CAPTION + CAPTION_END, ""), ROW)
            plain_rows = F.transform(rows, cells)
            spans = body.rlike(f"(?i)(?:row|col)span[^{CELL_END}]*{CELL_END}")
            grid = F.filter(
                F.when(spans, expanded(F.transform(rows, spanning_cells))).otherwise(plain_rows),
                lambda r: F.size(r) > 0,
            )
            return F.struct(_text(said).alias("caption"), grid.alias("grid"))

        numbers = F.filter(F.sequence(F.lit(0), done["next"]), lambda t: t < done["next"])
        return F.transform(numbers, one)

    def each_cell(row: Column) -> Column:
        return F.slice(F.split(row, CELL), F.lit(2), F.lit(REST))

    def said_in(cell: Column) -> Column:
        return _text(F.substring_index(cell, CELL_END, -1))

    def cells(row: Column) -> Column:
        return F.transform(each_cell(row), said_in)

    def spanning_cells(row: Column) -> Column:
        def one(cell: Column) -> Column:
            tag = F.substring_index(cell, CELL_END, 1)
            down, across = (F.coalesce(attribute(tag, a).try_cast("int"), F.lit(1)) for a in ("rowspan", "colspan"))
            return F.struct(
                F.when(down == 0, MOST_ROWS).otherwise(F.least(F.greatest(down, F.lit(1)), F.lit(MOST_ROWS))).alias("down"),
                F.least(F.greatest(across, F.lit(1)), F.lit(MOST_COLUMNS)).alias("across"),
                said_in(cell).alias("text"),
            )

        return F.transform(each_cell(row), one)

    return F.aggregate(stretches, begin, step, collect)


def expanded(rows: Column) -> Column:
    """The grid of rows of cells (down, across, text) that may span several places.

    A fold over the rows carries, for each column, how many more rows the cell in it covers.  A row's
    own cells, each as often as it is wide, take the columns that are free, from the left.
    """

    def bound(value: Column, use) -> Column:
        """``use`` of a value that is evaluated once."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def up_to(n: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), n), lambda i: i < n)

    def step(acc: Column, row: Column) -> Column:
        carry = acc["carry"]

        def covered(i: Column) -> Column:
            return F.coalesce(F.get(carry, i)["left"], F.lit(0)) > 0

        def with_own(own: Column) -> Column:
            free = F.filter(up_to(F.size(carry) + F.size(own)), lambda i: ~covered(i))
            return bound(free, lambda places: with_places(own, places))

        def with_places(own: Column, free: Column) -> Column:
            last = F.try_element_at(F.filter(up_to(F.size(carry)), covered), F.lit(-1))
            width = F.greatest(F.coalesce(last, F.lit(-1)), F.coalesce(F.get(free, F.size(own) - 1), F.lit(-1))) + 1

            def slot(i: Column) -> Column:
                mine = F.get(own, F.array_position(free, i).cast("int") - 1)
                return F.struct(
                    F.when(covered(i), F.get(carry, i)["left"] - 1).otherwise(F.coalesce(mine["down"] - 1, F.lit(0))).alias("left"),
                    F.when(covered(i), F.get(carry, i)["text"]).otherwise(F.coalesce(mine["text"], F.lit(""))).alias("text"),
                )

            return F.transform(up_to(width), slot)

        wide = F.flatten(F.transform(row, lambda c: F.array_repeat(c, c["across"])))
        return bound(
            bound(wide, with_own),
            lambda slots: F.struct(
                slots.alias("carry"),
                F.concat(acc["grid"], F.array(F.transform(slots, lambda x: x["text"]))).alias("grid"),
            ),
        )

    begin = F.struct(
        F.array().cast("array<struct<left:int,text:string>>").alias("carry"),
        F.array().cast("array<array<string>>").alias("grid"),
    )
    return F.aggregate(rows, begin, step, lambda done: done["grid"])


def grids(html: Column) -> Column:
    """Array of grids, one per table."""
    return F.transform(tables(html), lambda x: x["grid"])


# A name and its value, quoted either way or bare; values are skipped over whole.
ATTRIBUTE = r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""


def attribute(tag: Column, name: str) -> Column:
    """Attribute of one tag by its whole name; null when absent or empty.  The first one counts."""
    names = F.transform(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1)), F.lower)
    values = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(2))
    at = F.array_position(names, name).cast("int")
    value = F.when(at > 0, F.get(values, at - 1))
    bare = F.regexp_replace(value, r"""^["']|["']$""", "")
    return F.nullif(unescape(bare), F.lit(""))


def images(html: Column) -> Column:
    """Array of (image_path, caption, width, height), one per image tag.

    The caption is that of the figure the image stands in, else its alternative text.
    """
    found = F.slice(F.split(visible(html), r"(?i)<img\b"), F.lit(2), F.lit(REST))

    def one(piece: Column) -> Column:
        tag = F.substring_index(piece, ">", 1)
        figure = F.regexp_extract(piece, r"(?is)^(.*?)</figure\s*>", 1)
        said = plain(F.regexp_extract(figure, r"(?is)<figcaption\b[^>]*>(.*?)(?:</figcaption|$)", 1))
        return F.struct(
            attribute(tag, "src").alias("image_path"),
            F.coalesce(F.nullif(said, F.lit("")), attribute(tag, "alt"), F.lit("")).alias("caption"),
            attribute(tag, "width").try_cast("int").alias("width"),
            attribute(tag, "height").try_cast("int").alias("height"),
        )

    return F.transform(found, one)


def links(html: Column) -> Column:
    """Array of (image_path, caption): target and whole text of each link.

    A link that isn't closed ends where the next one begins.
    """
    marked = F.regexp_replace(visible(html), r"(?i)</a\s*>", ROW)
    marked = F.regexp_replace(marked, r"(?i)<a\b([^>]*)>", f"{PIECE}$1{TAG_END}")
    found = F.slice(F.split(marked, PIECE), F.lit(2), F.lit(REST))
    parsed = F.transform(
        found,
        lambda p: F.struct(
            attribute(F.substring_index(p, TAG_END, 1), "href").alias("image_path"),
            plain(F.substring_index(F.substring_index(p, TAG_END, -1), ROW, 1)).alias("caption"),
        ),
    )
    return F.filter(parsed, lambda x: x["image_path"].isNotNull())

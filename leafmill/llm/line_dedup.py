"""Line de-duplication by a segment-partition edit join, in Spark functions only.

Lines within ``tau`` edits share a segment: a line cut into tau + 1 segments can't have an edit in each.
A line is therefore looked up, for each length within tau below its own, under the substrings that can
stand for a segment of a line of that length (the windows in which both sides of the segment can still
be aligned).  Lines that meet under a substring are candidates and are verified by a banded edit
distance with that threshold.  Equal lines are one from the start, so a common line is one row here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import WORD, attach, numbered, only, texts_of, unused
from leafmill.llm.linkage import classes
from leafmill.scratch import settle

TAU = 2
LEAST_CHARS = 24


def lines_of(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rid_col: str | None = None
) -> DataFrame:
    """(rid, id, line_no, line, k): lines that have a word, numbered from 0, and their hash."""
    rows = texts_of(docs, id_col, text_col, rid_col)
    each = rows.select("rid", "id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return each.where(F.col("line").rlike(WORD)).withColumn("k", F.xxhash64("line"))


def parities(chars: Column) -> Column:
    """Which of 64 classes of characters, and of neighbouring pairs, a line has an odd number of.

    An edit flips two classes of characters and four of pairs at most.  ``chars`` is a column of its
    own: within a lambda an expression would be computed for each element.
    """

    def odd(items: Column) -> Column:
        bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(c), F.lit(64)))
        return F.aggregate(items, F.lit(0).cast("long"), lambda a, c: a.bitwiseXOR(bit(c)))

    pairs = F.transform(chars, lambda c, i: F.hash(c, F.get(chars, i + 1)))
    return F.struct(odd(chars).alias("chars"), odd(pairs).alias("pairs"))


def probes(lines: DataFrame, tau: int, least: int) -> DataFrame:
    """(id, bucket): the hashes of (length, segment number, substring) under which a line is looked up.

    ``lines`` is (id, line).  Those for a line's own length at the segments' own places are its index
    entries.  Lines that would be shorter than ``least`` are not looked for.  Places are columns of
    their own, so that the compiled expression stays small.
    """
    parts = tau + 1
    # UTF-32 has four bytes a code point, so that cutting needs no counting
    rows = lines.select("id", F.char_length("line").alias("n"), F.encode("line", "UTF-32").alias("wide"))
    rows = rows.where(F.col("n") >= least)
    sizes = rows.select(
        "*",
        *[F.expr(f"int((n - {d}) div {parts})").alias(f"base{d}") for d in range(parts)],
        *[F.expr(f"{parts} - (n - {d}) % {parts}").alias(f"short{d}") for d in range(parts)],
    )
    each = [(d, i) for d in range(parts) for i in range(parts)]
    placed = sizes.select(
        "id",
        "n",
        "wide",
        *[F.expr(f"4 * ({i} * base{d} + greatest(0, {i} - short{d})) + 1").alias(f"at{d}_{i}") for d, i in each],
        *[F.expr(f"4 * (base{d} + int({i} >= short{d}))").alias(f"size{d}_{i}") for d, i in each],
    )
    keys = [
        F.when(
            F.col("n") >= least + d,
            F.xxhash64(
                F.lit(i), F.col("n") - d, F.substring("wide", F.col(f"at{d}_{i}") + 4 * off, F.col(f"size{d}_{i}"))
            ),
        )
        for d, i in each
        for off in range(max(-i, d - (tau - i)), min(i, d + (tau - i)) + 1)
    ]
    return placed.select("id", F.explode(F.array(*keys)).alias("bucket")).where("bucket is not null")


def line_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tau: int = TAU,
    least_chars: int = LEAST_CHARS,
    rid_col: str | None = None,
) -> DataFrame:
    """One row per line with a word: (rid, id, line_no, keep_id, keep_line, group_size, kept).

    Lines are linked if equal, or if both have ``least_chars`` code points and at most ``tau`` edits
    lie between them (shorter lines have no room for an edit); classes are the connected components.
    The line with the smallest id stays (null last), then the earliest.  A null or empty text has no
    such lines; repeated rows repeat their lines; an empty table gives no rows; other columns are
    ignored.  Lines are told apart by 64-bit hashes.
    """
    lines = lines_of(docs, id_col, text_col, rid_col)
    seen = settle(lines.select("rid", "id", "line_no", "k"), "lines")
    total = seen.count()
    counts = settle(
        seen.groupBy("k").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct(F.col("id").isNull(), "id", "rid", "line_no")).alias("first"),
        ),
        "counts",
    )
    members = probes(lines.select(F.col("k").alias("id"), "line"), tau, least_chars)

    def texts(ids: DataFrame) -> DataFrame:
        """The lines that may be linked, once each."""
        some = only(lines.select(F.col("k").alias("id"), "line"), ids, "id")
        held = some.groupBy("id").agg(F.first("line").alias("line"))
        cut = held.select("id", "line", F.split("line", "").alias("chars"))
        return settle(cut.select("id", "line", parities(F.col("chars")).alias("sketch")), "texts")

    def few_flips(a: Column, b: Column) -> Column:
        flips = lambda k: F.bit_count(a[k].bitwiseXOR(b[k]))
        return (flips("chars") <= 2 * tau) & (flips("pairs") <= 4 * tau)

    def verify(pairs: DataFrame, held: DataFrame) -> DataFrame:
        one = held.select(F.col("id").alias("a"), F.col("line").alias("la"))
        two = held.select(F.col("id").alias("b"), F.col("line").alias("lb"))
        near = F.levenshtein("la", "lb", tau) >= 0
        return pairs.join(one, "a").join(two, "b").where(near).select("a", "b")

    labels = classes(members, texts, few_flips, verify)
    named = settle(
        counts.join(labels.select(F.col("id").alias("k"), "label"), "k", "left").withColumn(
            "label", F.coalesce("label", "k")
        ),
        "named",
    )
    whole = settle(
        named.groupBy("label").agg(
            F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("lines"), F.min("first").alias("stays")
        ),
        "classes",
    )
    told = settle(attach(named.select("label", "k", "n"), whole, ["label"], "lines", total), "told").select(
        "k", "n", "group_size", "stays"
    )
    return attach(seen, told, ["k"], "n", total).select(
        "rid", "id", "line_no",
        F.col("stays.id").alias("keep_id"), F.col("stays.line_no").alias("keep_line"), "group_size",
        ((F.col("rid") == F.col("stays.rid")) & (F.col("line_no") == F.col("stays.line_no"))).alias("kept"),
    )


def without_repeats(docs: DataFrame, *, text_col: str = "text", **how: object) -> DataFrame:
    """``docs`` with the lines that aren't kept taken out of its texts."""
    held, row = numbered(docs, "documents")
    told = line_dedup(held, text_col=text_col, rid_col=row, **how)
    gone = unused("_drop", held.columns)
    drop = told.where(~F.col("kept")).groupBy(F.col("rid").alias(row)).agg(F.collect_set("line_no").alias(gone))
    text = F.col(f"`{text_col}`")
    rest = F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(gone, i))
    cut = held.join(drop, row, "left").withColumn(
        text_col, F.when(F.col(gone).isNull(), text).otherwise(F.array_join(rest, "\n"))
    )
    return cut.drop(gone, row)

"""Same-page text as weak evidence for figure classes.

A figure's context is the first 200 characters of every block on its page, in
order, joined by spaces.  Only rule hits are needed from it, so the text itself
never meets the figures: each page part is searched where it is built, the hits
are OR-ed per page by partial aggregation, and one small row per page is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions import rules as R
from leafmill.functions.ordered import segment_of
from leafmill.functions.rules import Rule
from leafmill.operators import rule_index
from leafmill.scratch import settle

# Fixed value: characters of each block that count as context.
CONTEXT_CHARS = 200
PART_WIDTH = 4096


def page_context(
    blocks: DataFrame, *, width: int = PART_WIDTH, chars: int | None = CONTEXT_CHARS
) -> DataFrame:
    """(doc_id, page, part, context): block starts of ``chars`` characters (None: whole) joined by spaces.

    ``part`` is the block position divided by ``width``; a page whose blocks lie
    within one such stretch has a single part, which is its whole context.
    """
    start = F.col("text") if chars is None else F.left("text", F.lit(chars))
    ordered = F.sort_array(F.collect_list(F.struct("ord", start.alias("start"))))
    return (
        blocks.withColumn("part", segment_of("ord", width))
        .groupBy("doc_id", "page", "part")
        .agg(F.array_join(F.transform(ordered, lambda b: b["start"]), " ").alias("context"))
    )


def page_parts(blocks: DataFrame, reach: int, *, width: int, chars: int | None) -> DataFrame:
    """(doc_id, page, part, whole): page parts, each with the first ``reach`` characters that follow it.

    So a needle of up to ``reach`` characters that straddles two parts is found in one of them.
    """
    # Without a part nothing is joined below; said here, both sides of that join come from one shuffle.
    parts = page_context(blocks, width=width, chars=chars).where("part is not null")
    following = (
        Window.partitionBy("doc_id", "page").orderBy("part").rowsBetween(1, reach)
    )
    overlap = parts.select(
        "doc_id", "page", "part", F.left("context", F.lit(reach)).alias("start")
    ).select(
        "doc_id",
        "page",
        "part",
        F.left(
            F.concat(F.lit(" "), F.array_join(F.collect_list("start").over(following), " ")),
            F.lit(reach),
        ).alias("tail"),
    )
    return parts.join(overlap, ["doc_id", "page", "part"]).select(
        "doc_id", "page", "part", F.concat("context", "tail").alias("whole")
    )


def page_hits(
    blocks: DataFrame,
    rules: Sequence[Rule] = R.FIGURE_RULES,
    *,
    width: int = PART_WIDTH,
    chars: int | None = CONTEXT_CHARS,
) -> DataFrame:
    """(doc_id, page, hits, head): which context rules hit the page, and how its context begins.

    ``hits`` has one boolean per context rule.
    """
    context_rules = [r for r in R.ordered_rules(rules) if not r.caption_only]
    reach = max([len(n) for r in context_rules for n in r.needles], default=1)
    searched = page_parts(blocks, reach, width=width, chars=chars).withColumn("low", F.lower("whole"))
    found = [
        F.bool_or(R.hits(F.col("low"), r)).alias(f"__r{i}") for i, r in enumerate(context_rules)
    ]
    return (
        searched.groupBy("doc_id", "page")
        .agg(*found, F.min_by(F.left("whole", F.lit(reach)), "part").alias("head"))
        .select(
            "doc_id",
            "page",
            F.array(*[F.col(f"__r{i}") for i in range(len(context_rules))])
            .cast("array<boolean>")
            .alias("hits"),
            "head",
        )
    )


def classify_figures(
    figures: DataFrame,
    blocks: DataFrame,
    rules: Sequence[Rule] = R.FIGURE_RULES,
    default: Rule = R.NO_RULE,
    *,
    width: int = PART_WIDTH,
    chars: int | None = CONTEXT_CHARS,
) -> DataFrame:
    """Add ``classification`` from the caption and the text of the same page."""
    pages = page_hits(blocks, rules, width=width, chars=chars)
    caption = F.coalesce("caption", F.lit(""))
    # Needles can also straddle the end of the caption and the start of the context.
    seam = F.concat(caption, F.lit(" "), F.coalesce("head", F.lit("")))
    lowered = figures.join(pages, ["doc_id", "page"], "left").select(
        *[figures[c] for c in figures.columns],
        "hits",
        F.lower(caption).alias("__low_caption"),
        F.lower(seam).alias("__low_seam"),
    )
    return lowered.select(*figures.columns, _first_match(rules, default).alias("classification"))


def _first_match(rules: Sequence[Rule], default: Rule) -> Column:
    tests, n = [], 0
    for rule in R.ordered_rules(rules):
        if rule.caption_only:
            tests.append((R.hits(F.col("__low_caption"), rule), R.verdict(rule)))
        else:
            on_page = F.coalesce(F.get("hits", F.lit(n)), F.lit(False))
            tests.append((on_page | R.hits(F.col("__low_seam"), rule), R.verdict(rule)))
            n += 1
    return R.case_chain(tests, R.verdict(default))


def classify_figures_by_table(
    figures: DataFrame,
    blocks: DataFrame,
    rules: DataFrame,
    default: Rule = R.NO_RULE,
    *,
    width: int = PART_WIDTH,
    chars: int | None = CONTEXT_CHARS,
) -> DataFrame:
    """The same with a table of rules of any size.

    Only the first rule counts, so a page is reduced to the first context rule that hits it before it
    meets its figures; captions, and where they meet the context, are searched on their own.
    """
    needle = F.max(F.char_length("needle"))
    reach = max(rules.select(F.explode("needles").alias("needle")).agg(needle).first()[0] or 1, 1)
    parts = settle(page_parts(blocks, reach, width=width, chars=chars), "parts")
    part, page, key = ["doc_id", "page", "part"], ["doc_id", "page"], ["doc_id", "figure_id"]
    context_rules = rules.where("not coalesce(caption_only, false)")
    hit = rule_index.first_rules(parts, part, context_rules, F.lit(""), F.col("whole"))
    on_page = hit.groupBy(*page).agg(F.min("rank").alias("__page_rank"))
    heads = parts.groupBy(*page).agg(F.min_by(F.left("whole", F.lit(reach)), "part").alias("__head"))
    caption = F.coalesce("caption", F.lit(""))
    seam = F.concat(caption, F.lit(" "), F.coalesce("__head", F.lit("")))
    seamed = settle(
        figures.join(heads, page, "left").select(*key, caption.alias("caption"), seam.alias("seam")), "seams"
    )
    own = rule_index.first_rules(seamed, key, rules, F.col("caption"), F.col("seam"))
    ranked = figures.join(on_page, page, "left").join(own.withColumnRenamed("rank", "__own_rank"), key, "left")
    rank = F.least("__own_rank", "__page_rank")
    return ranked.select(
        *[figures[c] for c in figures.columns], rule_index.verdict_of(rank, default).alias("classification")
    )

"""Ordered keyword rules kept as data.

A rule hits when any of its needles is a substring of the lower-cased text; the
first rule that hits decides.  A list becomes one CASE chain; a table of rules, of
any size, is searched by ``operators/rule_index.py``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    needles: tuple[str, ...]
    label: str
    confidence: float = 0.0
    rationale: str = ""
    caption_only: bool = False


# Caption and context rules, in order; caption-only rules go first.
FIGURE_RULES: tuple[Rule, ...] = (
    Rule(("table",), "table_image", 0.75, "caption suggests table in image", caption_only=True),
    Rule(("timing",), "timing_diagram", 0.92, "caption mentions timing"),
    Rule(("state",), "state_machine", 0.88, "caption mentions state"),
    Rule(("block diagram",), "block_diagram", 0.9, "caption mentions block diagram"),
    Rule(("schematic",), "block_diagram", 0.72, "schematic-like wording"),
    Rule(("plot",), "plot", 0.85, "caption mentions plot"),
    Rule(("graph",), "plot", 0.8, "caption mentions graph"),
    Rule(("waveform",), "timing_diagram", 0.82, "caption mentions waveform"),
)
NO_RULE = Rule((), "other", 0.4, "no rule matched")

# Description rules, in order.  A needle that holds another one of its rule is left out: it hits nothing more.
DESCRIPTION_RULES: tuple[Rule, ...] = (
    Rule(("logo",), "logo"),
    Rule(("icon", "symbol", "arrow"), "icon"),
    Rule(("pin",), "pinout"),
    Rule(("schematic", "circuit diagram"), "schematic"),
    Rule(("timing", "waveform", "clock"), "timing_diagram"),
    Rule(("state machine", "state diagram", "flowchart"), "state_machine"),
    Rule(("register", "bit field"), "register_map"),
    Rule(("block diagram", "functional block"), "block_diagram"),
    Rule(("wiring", "hookup", "connection diagram"), "wiring_diagram"),
    Rule(("plot", "graph", "chart", "x-axis", "y-axis", "linearity", "error", "vs"), "plot"),
    Rule(("table", "row", "column", "header"), "table_image"),
    Rule(("circuit board", "inputs and outputs", "chip diagram"), "block_diagram"),
    Rule(("photo", "pcb", "board", "chip"), "photo"),
    Rule(("screenshot", "ide", "terminal", "oscilloscope"), "screenshot"),
    Rule(("package", "dimension", "footprint", "mechanical"), "mechanical"),
)
OTHER = Rule((), "other")

# Tag vocabulary.
TAGS: tuple[str, ...] = (
    "i2c",
    "dac",
    "adc",
    "voltage",
    "timing",
    "state",
    "register",
    "pin",
    "power",
)

def hits(text: Column, rule: Rule) -> Column:
    """Does a rule hit text that is already lower-cased?"""
    found = F.lit(False)
    for needle in rule.needles:
        found = found | F.contains(text, F.lit(needle))
    return found


def verdict(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.label).alias("type"),
        F.lit(float(rule.confidence)).alias("confidence"),
        F.lit(rule.rationale).alias("rationale"),
    )


def ordered_rules(rules: Sequence[Rule]) -> list[Rule]:
    """Caption-only rules first, otherwise as given."""
    return [r for r in rules if r.caption_only] + [r for r in rules if not r.caption_only]


def case_chain(tests: Sequence[tuple[Column, Column]], default: Column) -> Column:
    if not tests:
        return default
    chain = F.when(*tests[0])
    for test, value in tests[1:]:
        chain = chain.when(test, value)
    return chain.otherwise(default)


def classify(
    df: DataFrame,
    caption: Column,
    context: Column | None = None,
    rules: Sequence[Rule] = FIGURE_RULES,
    default: Rule = NO_RULE,
    *,
    out: str = "classification",
) -> DataFrame:
    """Add the first-match class of a caption and its surrounding text: (type, confidence, rationale).

    Lower-casing happens in a projection of its own, once per row rather than
    once per needle.
    """
    caption = F.coalesce(caption, F.lit(""))
    context = F.lit("") if context is None else F.coalesce(context, F.lit(""))
    lowered = df.select(
        *df.columns,
        F.lower(caption).alias("__low_caption"),
        F.lower(F.concat(caption, F.lit(" "), context)).alias("__low_both"),
    )
    low_caption, low_both = F.col("__low_caption"), F.col("__low_both")
    ordered = ordered_rules(rules)
    tests = [(hits(low_caption if r.caption_only else low_both, r), verdict(r)) for r in ordered]
    found = case_chain(tests, verdict(default))
    return lowered.select(*df.columns, found.alias(out))


def infer_label(
    df: DataFrame,
    text: Column | str,
    rules: Sequence[Rule] = DESCRIPTION_RULES,
    default: Rule = OTHER,
    *,
    out: str = "label",
) -> DataFrame:
    """Add the first-match label of a free-text description."""
    text = F.col(text) if isinstance(text, str) else text
    lowered = df.select(*df.columns, F.lower(text).alias("__low"))
    found = case_chain([(hits(F.col("__low"), r), F.lit(r.label)) for r in rules], F.lit(default.label))
    return lowered.select(*df.columns, found.alias(out))


def tags(*texts: Column, vocabulary: Sequence[str] = TAGS) -> Column:
    """Vocabulary terms found as substrings, sorted and unique."""
    low = F.transform(F.array(F.lower(F.concat_ws(" ", *texts))), _terms_in(vocabulary))
    return F.flatten(low)


def _terms_in(vocabulary: Sequence[str]):
    terms = sorted(set(vocabulary))

    def search(low: Column) -> Column:
        found = [F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in terms]
        return F.filter(F.array(*found), lambda t: t.isNotNull())

    return search

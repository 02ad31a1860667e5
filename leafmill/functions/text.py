"""Scalar text expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Validity thresholds and the special tokens removed before checking.
MIN_PRINTABLE_RATIO = 0.6
MIN_LETTERS = 10
SPECIAL_TOKENS = ("<unk>", "<s>", "</s>")

# Unicode letters, marks, numbers, punctuation, symbols and the plain space.  The ASCII range
# repeats a part of them: it is tested first and settles most characters.
NOT_PRINTABLE = r"[^ -~\p{L}\p{M}\p{N}\p{P}\p{S}]+"
NOT_LETTER = r"[^\p{L}]+"
AT_LEAST_TEN_LETTERS = rf"(?:\p{{L}}[^\p{{L}}]*){{{MIN_LETTERS}}}"
# Unicode white space plus the four separator controls.
SPACE = r"[\s\x1c-\x1f]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing Unicode white space.

    Only text that begins or ends with it goes through the pattern.
    """
    c = col(c)
    edges = F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1)))
    trimmed = F.regexp_replace(c, rf"(?U)^{SPACE}+|{SPACE}+$", "")
    return F.when(edges.rlike(rf"(?U){SPACE}"), trimmed).otherwise(c)


def is_blank(c: Column | str) -> Column:
    """True for null, empty and white-space-only text."""
    return ~F.coalesce(col(c).rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))


def printable_count(c: Column | str) -> Column:
    return F.length(F.regexp_replace(col(c), NOT_PRINTABLE, ""))


def letter_count(c: Column | str) -> Column:
    return F.length(F.regexp_replace(col(c), NOT_LETTER, ""))


def without_special_tokens(c: Column | str) -> Column:
    c = out = col(c)
    for token in SPECIAL_TOKENS:
        out = F.replace(out, F.lit(token), F.lit(""))
    return F.when(F.contains(c, F.lit("<")), out).otherwise(c)


def is_valid_description(c: Column | str) -> Column:
    """Does the text look like language rather than control characters or tokens?

    Ten letters imply that the text is neither blank nor empty without its tokens.
    """
    cleaned = without_special_tokens(c)
    ratio = F.try_divide(printable_count(cleaned), F.length(cleaned))
    return F.coalesce(
        cleaned.rlike(AT_LEAST_TEN_LETTERS) & (ratio >= F.lit(MIN_PRINTABLE_RATIO)), F.lit(False)
    )


def percent(done: Column, total: Column) -> Column:
    """100 * done / total with one decimal, ties to even; 0 of 0 is 0."""
    return F.bround(F.lit(100.0) * done / F.greatest(total, F.lit(1)), 1)


def file_name(path: Column | str) -> Column:
    return F.regexp_extract(col(path), r"([^/]+)/*$", 1)


def file_stem(path: Column | str) -> Column:
    return F.regexp_extract(file_name(path), r"^(.+?)(\.[^.]*)?$", 1)


def words(c: Column | str) -> Column:
    """White-space separated tokens; blank text has none."""
    return F.array_remove(F.split(col(c), r"\s+"), "")


def ordinal_of(identifier: Column | str) -> Column:
    """Trailing number of an id such as ``fig_0012``."""
    return F.regexp_extract(col(identifier), r"(\d+)$", 1).try_cast("bigint")


def numbered_id(prefix: str, n: Column | str) -> Column:
    """``prefix_0001``; widens past four digits instead of cutting."""
    digits = col(n).cast("string")
    padded = F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits)
    return F.concat(F.lit(f"{prefix}_"), padded)

"""Running sums, running maxima and numbering per key that tolerate one huge key.

A plain ``Window.partitionBy(key).orderBy(pos)`` sends every row of a key to one
task.  Here each key is cut into segments of ``width`` consecutive positions, so
no task sorts more than ``width`` rows of a key:

1. one partial-aggregated total per (key, segment);
2. a running carry over those totals, one small row per segment, which is itself
   cut into segments of segments, so that sparse positions (each row a segment of
   its own) don't bring a key together either;
3. the window runs inside (key, segment) and the carry is added.

The position column must be an integer that is unique within its key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT_WIDTH = 1 << 20
_SEG = "__segment"
_GROUP = "__segments"


def segment_of(order: str, width: int) -> Column:
    """Number of the ``width``-wide segment that a position falls into."""
    return F.expr(f"`{order}` div {int(width)}")


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    sums: Mapping[str, Column] | None = None,
    maxes: Mapping[str, Column] | None = None,
    width: int = SEGMENT_WIDTH,
) -> DataFrame:
    """Add inclusive running sums and maxima per key, in position order.

    ``sums`` and ``maxes`` map an output column to the expression to accumulate.
    Nulls are ignored; a running sum over nothing is 0, a running maximum null.
    """
    sums, maxes = dict(sums or {}), dict(maxes or {})
    group = [*keys, _SEG]
    cut = df.withColumn(_SEG, segment_of(order, width))

    totals = cut.groupBy(*group).agg(
        *[F.sum(e).alias(f"__t_{n}") for n, e in sums.items()],
        *[F.max(e).alias(f"__t_{n}") for n, e in maxes.items()],
    )
    names = [f"__t_{n}" for n in sums], [f"__t_{n}" for n in maxes]
    carry = _carry(totals, keys, *names, width)

    inside = (
        Window.partitionBy(*group)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = cut.join(carry, group)
    zero = F.lit(0)
    return joined.select(
        *df.columns,
        *[
            (F.coalesce(F.col(f"__c_{n}"), zero) + F.coalesce(F.sum(e).over(inside), zero)).alias(n)
            for n, e in sums.items()
        ],
        *[
            F.greatest(F.col(f"__c_{n}"), F.max(e).over(inside)).alias(n)
            for n, e in maxes.items()
        ],
    )


def _carry(
    totals: DataFrame, keys: Sequence[str], sums: Sequence[str], maxes: Sequence[str], width: int
) -> DataFrame:
    """Per (key, segment), what the segments before it add up to: columns ``__c_`` for ``__t_``."""
    cut = totals.withColumn(_GROUP, segment_of(_SEG, width))
    far = cut.groupBy(*keys, _GROUP).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in maxes]
    )

    def earlier(group: Sequence[str], order: str):
        return Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    over = earlier(keys, _GROUP)
    before = far.select(
        *keys,
        _GROUP,
        *[F.sum(c).over(over).alias(f"__far{c}") for c in sums],
        *[F.max(c).over(over).alias(f"__far{c}") for c in maxes],
    )
    near = earlier([*keys, _GROUP], _SEG)
    zero = F.lit(0)
    return cut.join(before, [*keys, _GROUP]).select(
        *keys,
        _SEG,
        *[
            (F.coalesce(F.col(f"__far{c}"), zero) + F.coalesce(F.sum(c).over(near), zero)).alias(
                c.replace("__t_", "__c_", 1)
            )
            for c in sums
        ],
        *[
            F.greatest(F.col(f"__far{c}"), F.max(c).over(near)).alias(c.replace("__t_", "__c_", 1))
            for c in maxes
        ],
    )


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str = "n",
    width: int = SEGMENT_WIDTH,
) -> DataFrame:
    """Dense 1-based position of each row within its key."""
    return with_running(df, keys, order, sums={out: F.lit(1).cast("bigint")}, width=width)

"""What five filters remove in any order, from count-weighted decision diagrams.

Each text has a mask of the filters it fails.  Spark reduces the corpus to counts for each part and
mask: at most 32 rows a part, whatever the input.  A part's counts become a decision diagram with one
level per filter: a node has a child for texts that pass and one for texts that fail, and weighs what
both weigh; equal nodes are one.  Swapping two adjacent levels rebuilds only nodes of those two levels,
and 119 such swaps visit all 120 orders.  In each order the path on which every filter is passed tells,
step by step, what is kept, and its other children what is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import HOT_SHARE
from leafmill.scratch import settle

FILTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)

Weight = tuple[int, ...]


class Diagram:
    """A quasi-reduced diagram: every path has one node per variable, and equal nodes are shared.

    A node is a number; ``low`` is where the variable is 0 (passed), ``high`` where it is 1 (failed), and
    ``weight`` adds up the weights of all masks below.
    """

    def __init__(self, variables: str, weights: dict[int, Weight], zero: Weight):
        self.order = list(variables)
        self.low: list[int] = []
        self.high: list[int] = []
        self.weight: list[Weight] = []
        self.known: dict[tuple, int] = {}
        self.levels: list[set[int]] = [set() for _ in variables]
        self.root = self.build(0, 0, weights, zero)

    def leaf(self, weight: Weight) -> int:
        return self.put(("leaf", weight), -1, -1, weight)

    def put(self, key: tuple, low: int, high: int, weight: Weight) -> int:
        if key not in self.known:
            self.known[key] = len(self.weight)
            self.low.append(low)
            self.high.append(high)
            self.weight.append(weight)
        return self.known[key]

    def node(self, level: int, low: int, high: int) -> int:
        """The node of a level with these children, made once."""
        weight = tuple(map(sum, zip(self.weight[low], self.weight[high], strict=True)))
        made = self.put((self.order[level], low, high), low, high, weight)
        self.levels[level].add(made)
        return made

    def build(self, level: int, mask: int, weights: dict[int, Weight], zero: Weight) -> int:
        if level == len(self.order):
            return self.leaf(weights.get(mask, zero))
        return self.node(
            level, self.build(level + 1, mask, weights, zero), self.build(level + 1, mask | 1 << level, weights, zero)
        )

    def swap(self, level: int) -> None:
        """Exchange the variables of ``level`` and the next; nodes above keep their function."""
        old = self.levels[level]
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        self.levels[level], self.levels[level + 1] = set(), set()
        moved = {}
        for n in old:
            (a, b), (c, d) = ((self.low[x], self.high[x]) for x in (self.low[n], self.high[n]))
            moved[n] = self.node(level, self.node(level + 1, a, c), self.node(level + 1, b, d))
        for up in range(level - 1, -1, -1):  # their children have new numbers
            nodes, self.levels[up] = self.levels[up], set()
            moved = {n: self.node(up, moved[self.low[n]], moved[self.high[n]]) for n in nodes}
        self.root = moved[self.root]

    def path(self) -> Iterator[tuple[str, Weight, Weight]]:
        """Along the path on which all is passed: (variable, weight that fails here, weight that passes)."""
        at = self.root
        for variable in self.order:
            yield variable, self.weight[self.high[at]], self.weight[self.low[at]]
            at = self.low[at]


def adjacent_swaps(n: int) -> list[int]:
    """Positions of adjacent swaps that lead through all orders of n things.

    The last thing sweeps to and fro through the orders of the others; between two sweeps the others
    make their own next swap, one place further right while the last thing stands in front.
    """
    if n < 2:
        return []
    out, down = [], True
    for inner in [*adjacent_swaps(n - 1), None]:
        out += range(n - 2, -1, -1) if down else range(n - 1)
        if inner is not None:
            out.append(inner + down)
        down = not down
    return out


def audited(part: str, weights: dict[int, Weight], filters: str = FILTERS) -> list[tuple]:
    """The rows of one part: every order and step, with counts of (texts, good, toxic)."""
    diagram = Diagram(filters, weights, (0, 0, 0))
    paths = [list(diagram.path())]
    orders = ["".join(diagram.order)]
    for level in adjacent_swaps(len(filters)):
        diagram.swap(level)
        paths.append(list(diagram.path()))
        orders.append("".join(diagram.order))
    failing = {path[0][0]: path[0][1][0] for path in paths}  # as the first filter it removes all that fail it
    alone = {path[-1][0]: path[-1][1][0] for path in paths}  # as the last one only what fails it alone
    shapley = dict.fromkeys(filters, 0)
    for path in paths:
        for name, fails, _ in path:
            shapley[name] += fails[0]
    return [
        (part, order, step, passes[0], n, failing[name] - n, alone[name], good, toxic, shapley[name])
        for order, path in zip(orders, paths, strict=True)
        for step, (name, (n, good, toxic), passes) in enumerate(path, 1)
    ]


def audits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in STEPS.split(", ")]
    for frame in frames:
        for part, counts in zip(frame["part"], frame["counts"], strict=True):
            weights = {int(c["mask"]): (int(c["n"]), int(c["good"]), int(c["toxic"])) for c in counts}
            yield pd.DataFrame(audited(part, weights), columns=names)


def own_mask(text: Column) -> Column:
    """The filters that a text fails by itself, one bit each from A."""
    words = F.array_remove(F.split(text, SPACE), "")

    def judged(words: Column) -> Column:
        n, distinct = F.size(words), F.size(F.array_distinct(words))
        a, b = n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * n
        return F.when(a, 1).otherwise(0) + F.when(b, 2).otherwise(0)

    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    c = 100 * capitals > MOST_CAPITALS * F.char_length(text).cast("long")
    d = text.rlike(r"[#$%&*|]")
    # a transform of one element evaluates the words once
    by_words = F.transform(F.array(words), judged)[0]
    return by_words + F.when(c, 4).otherwise(0) + F.when(d, 8).otherwise(0)


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask) of each row; bit 4 is set if a smaller id has the same text.

    Equal texts are told by SHA-256.  A text that holds over 1/HOT_SHARE of all rows is broadcast, so
    that its rows stay where they are.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = settle(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
            own_mask(text).alias("mask"),
        ),
        "masks",
    )
    groups = rows.groupBy("sha").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least"))
    repeats = settle(groups.where("size > 1 and least is not null"), "repeats")
    hot = F.col("size") * HOT_SHARE > rows.count()
    still = rows.join(F.broadcast(repeats.where(hot)), "sha")
    rest = rows.join(F.broadcast(repeats.where(hot).select("sha")), "sha", "left_anti")
    all_ = still.unionByName(rest.join(repeats.where(~hot), "sha", "left"))
    later = F.col("least").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("least")))
    return all_.select("id", "part", (F.col("mask") + F.when(later, 16).otherwise(0)).alias("mask"))


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """For every part, order of the filters and step: what is kept, removed, redundant and lost.

    A null text is empty, a null part is the empty string.  A row repeats if any row with a smaller id
    has the same text, whichever part that is in; a null id counts as larger than any other, and rows
    with equal ids don't repeat each other.  Labels count for every row of their id; of several labels
    of an id one 1 is enough, null ids have none.  Texts are read as a whole whatever their length, an
    empty table gives no rows, and other columns are ignored.

    Counts of (id, part, mask) are made before labels are joined, so an id in a third of all rows is a few.
    """
    marked = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    counted = masks(docs, id_col, text_col, part_col).groupBy("id", "part", "mask").count()
    sums = (
        counted.join(marked, "id", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("count").alias("n"),
            F.sum(F.col("count") * F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.col("count") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )
    return sums.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts")).mapInPandas(audits, STEPS)

"""Vectors as short codes: a small codebook for each part, searched by a GNAT.

A vector becomes integers and is cut into equal parts.  Each part position has a codebook, refined by
Lloyd rounds: every part is assigned to its nearest entry, and every entry moves to the floored mean of
its parts.  A round is one pass over the table in which each task sums up its own parts; a few rows
per task are shuffled, and only the codebooks pass through the driver.

The nearest entry is found by a geometric near-neighbour access tree over the entries.  A node has
split points, and for each pair of them the range of distances from the one to all entries of the
other's subtree.  A query that is further than its best distance from such a range leaves the subtree
out.  Distances in the tree are floats that are rounded so that nothing is left out unless it is
strictly further; whatever remains is compared by integers, so ties are exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import attach
from leafmill.scratch import settle

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
DEGREE = 4
LIMB_BITS = 40
"""Sums travel in limbs of so many bits: no sum of longs overflows below 2^23 tasks, whatever the vectors."""
SLACK = 2.0**-50
"""More than the rounding errors of a square root, a difference and the conversion of its integers."""


def root(squares: np.ndarray) -> np.ndarray:
    if squares.dtype != object:
        return np.sqrt(squares.astype(np.float64))
    return np.array([math.sqrt(x) if x < 1 << 1000 else math.inf for x in squares], dtype=np.float64)


def squared(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    return ((points - point) ** 2).sum(axis=1)


@dataclass
class Node:
    """Split points, the ranges of distances from each to every subtree, and those subtrees."""

    splits: list[int]
    low: np.ndarray
    high: np.ndarray
    below: list[Node | None] = field(default_factory=list)


class Gnat:
    """The exact nearest of a few integer points for many queries at once; ties go to the lower index."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE):
        self.points, self.degree = points, degree
        self.top = self.node(list(range(len(points))))

    def node(self, ids: list[int]) -> Node:
        # split points far from each other: the first, then always the one furthest from those chosen
        splits = [ids[0]]
        nearest = squared(self.points[ids], self.points[ids[0]])
        while len(splits) < min(self.degree, len(ids)):
            rest = [(nearest[k], -i) for k, i in enumerate(ids) if i not in splits]
            splits.append(-max(rest)[1])
            nearest = np.minimum(nearest, squared(self.points[ids], self.points[splits[-1]]))
        gaps = np.stack([squared(self.points[ids], self.points[s]) for s in splits])
        home = gaps.argmin(axis=0)
        for k, s in enumerate(splits):
            home[ids.index(s)] = k
        low, high = np.zeros((len(splits),) * 2), np.zeros((len(splits),) * 2)
        below: list[Node | None] = []
        for j, s in enumerate(splits):
            own = np.flatnonzero(home == j)
            far = np.stack([root(gaps[i, own]) for i in range(len(splits))])
            low[:, j], high[:, j] = far.min(axis=1) * (1 - SLACK), far.max(axis=1) * (1 + SLACK)
            rest = [ids[k] for k in own if ids[k] != s]
            below.append(self.node(rest) if rest else None)
        return Node(splits, low, high, below)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each query's nearest point."""
        index = np.full(len(queries), len(self.points))
        best = np.zeros(len(queries), queries.dtype)
        todo = [(self.top, np.arange(len(queries)))]
        while todo:
            node, rows = todo.pop()
            alive = np.ones((len(rows), len(node.splits)), bool)
            for i, s in enumerate(node.splits):
                at = np.flatnonzero(alive[:, i])
                who = rows[at]
                gap = squared(queries[who], self.points[s])
                won = (index[who] == len(self.points)) | (gap < best[who]) | ((gap == best[who]) & (s < index[who]))
                best[who[won]], index[who[won]] = gap[won], s
                here = root(gap)[:, None]
                reach = root(best[who])[:, None] * (1 + SLACK)
                with np.errstate(invalid="ignore"):  # of two infinities nothing is known: kept
                    further = (here * (1 - SLACK) - node.high[i] > reach) | (node.low[i] - here * (1 + SLACK) > reach)
                alive[at] &= ~further
            for j, child in enumerate(node.below):
                if child is not None and alive[:, j].any():
                    todo.append((child, rows[alive[:, j]]))
        return index, best


def bound(width: int) -> float:
    """Integers below it have squared distances over ``width`` places that fit 63 bits."""
    return 2.0**30 / math.sqrt(max(width, 1))


def whole(values: np.ndarray, scale: int, width: int) -> np.ndarray:
    """floor(scale * x): as 64-bit integers where squared distances fit, else as Python integers."""
    if not values.size or np.abs(values).max() < (bound(width) - 1) / scale:
        return np.floor(values * scale).astype(np.int64)
    exact = [math.floor(x * scale) if abs(x) < 2.0**52 else int(x) * scale for x in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which vectors are kept, which of those have ``dim`` components, and these as rows."""
    size = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(size)), np.maximum(size, 0))
    fine = size >= 0
    fine[owner[~np.isfinite(flat)]] = False
    fits = fine & (size == dim)
    return fine, fits, flat[fits[owner]].reshape(-1, dim)


def cut(values: np.ndarray, parts: int, scale: int) -> np.ndarray:
    """The parts of integer vectors: (parts, rows, width)."""
    width = values.shape[1] // parts
    return whole(values, scale, width).reshape(len(values), parts, width).swapaxes(0, 1)


def matched(tree: Gnat, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries; where one side needs Python integers, both are compared so."""
    if part.dtype == tree.points.dtype:
        return tree.nearest(part)
    return Gnat(tree.points.astype(object)).nearest(part.astype(object))


def limbs(x: int) -> Iterator[tuple[int, int]]:
    sign, x, k = (-1 if x < 0 else 1), abs(x), 0
    while x:
        yield k, sign * (x & ((1 << LIMB_BITS) - 1))
        x, k = x >> LIMB_BITS, k + 1


def summed(books: list[np.ndarray], dim: int, scale: int):
    """Per task: for each part, entry and place in the part the sum of its parts; the last place counts."""
    trees = [Gnat(b) for b in books]
    parts, entries, width = len(books), len(books[0]), dim // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), dtype=object)
        for batch in batches:
            values = matrix(batch.column(0), dim)[2]
            for p, part in enumerate(cut(values, parts, scale)):
                index, _ = matched(trees[p], part)
                sums = np.zeros((entries, width + 1), part.dtype)
                np.add.at(sums, index, np.column_stack([part, np.ones(len(part), part.dtype)]))
                total[p] += sums.astype(object)
        rows = [(slot, k, v) for slot, x in enumerate(total.ravel().tolist()) for k, v in limbs(int(x))]
        columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], []]
        yield pa.record_batch(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64())],
            names=["slot", "limb", "value"],
        )

    return run


def assigned(books: list[np.ndarray], dim: int, scale: int):
    """Code and error of each kept vector."""
    trees = [Gnat(b) for b in books]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine, fits, values = matrix(batch.column(2), dim)
            index = np.zeros((len(values), len(books)), np.int64)
            error = np.zeros(len(values), dtype=object)
            for p, part in enumerate(cut(values, len(books), scale)):
                index[:, p], best = matched(trees[p], part)
                error += best.astype(object)
            codes = ["".join(f"{i:02x}" for i in row) for row in index.tolist()]
            told = [(c, e if e < 1 << 63 else None) for c, e in zip(codes, error.tolist(), strict=True)]
            place = np.full(len(fine), -1)
            place[fits] = np.arange(len(values))
            told = [told[k] if k >= 0 else (None, None) for k in place[fine].tolist()]
            mask = pa.array(fine)
            yield pa.record_batch(
                [
                    batch.column(0).filter(mask), batch.column(1).filter(mask),
                    pa.array([c for c, _ in told], pa.string()), pa.array([e for _, e in told], pa.int64()),
                ],
                names=["id", "label", "code", "error"],
            )

    return run


def refined(rows: DataFrame, books: list[np.ndarray], dim: int, scale: int) -> list[np.ndarray]:
    """The codebooks after one more round over all rows."""
    parts, entries, width = len(books), len(books[0]), dim // len(books)
    sums = (
        rows.select("vector")
        .mapInArrow(summed(books, dim, scale), "slot int, limb int, value long")
        .groupBy("slot", "limb")
        .agg(F.sum("value").alias("value"))
        .collect()  # parts x entries x (width + 1) sums, whatever the table
    )
    total = np.zeros(parts * entries * (width + 1), dtype=object)
    for row in sums:
        total[row["slot"]] += row["value"] << (LIMB_BITS * row["limb"])
    out = []
    for book, part in zip(books, total.reshape(parts, entries, width + 1), strict=True):
        moved = [
            [x // t[-1] for x in t[:-1]] if t[-1] else [int(x) for x in old]
            for old, t in zip(book, part.tolist(), strict=True)
        ]
        out.append(integers(moved))
    return out


def integers(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(x) < bound(len(row)) for row in rows for x in row)
    return np.array(rows, dtype=np.int64 if small else object)


def finite(vector: Column) -> Column:
    """Not null, and without null, NaN or infinite components."""
    return vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))


def codebooks(
    rows: DataFrame, parts: int, entries: int, rounds: int, scale: int
) -> tuple[int, list[np.ndarray]]:
    """(length of a vector, codebook of each part); (0, []) where no vector can be cut."""
    x = F.col("vector")
    kept = rows.where(finite(x) & (F.size(x) > 0) & (F.size(x) % parts == 0))
    order = [F.col("id").asc_nulls_last(), F.col("vector")]
    first = kept.orderBy(*order).select(F.size("vector")).head()
    if first is None:
        return 0, []
    dim = first[0]
    seeds = kept.where(F.size("vector") == dim).orderBy(*order).limit(entries).select("vector").collect()
    values = np.array([r[0] for r in seeds], dtype=np.float64)
    books = [integers(part.tolist()) for part in cut(values, parts, scale)]
    for _ in range(rounds):
        books = refined(rows, books, dim, scale)
    return dim, books


def vector_codes(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, code, error, label_error) of each kept vector, and the codebooks.

    Rows whose vector is null or holds null, NaN or infinite components are dropped.  The length of
    vectors is that of the first kept one (smallest id, null last, then smallest vector) that can be cut
    into ``parts``; kept rows of another length have a null code and error.  Repeated ids are rows of
    their own, fewer vectors than ``entries`` give smaller codebooks, and an empty table gives no rows
    and no codebooks.  Any finite components are coded exactly; a sum beyond 63 bits is null.  Null
    labels are one label; other columns are ignored.
    """
    col = {c: F.col(f"`{c}`") for c in (id_col, vector_col, label_col)}
    rows = vectors.select(
        col[id_col].alias("id"), col[label_col].alias("label"), col[vector_col].cast("array<double>").alias("vector")
    )
    dim, books = codebooks(rows, parts, entries, rounds, scale)
    kinds = rows.schema
    out = f"id {kinds['id'].dataType.simpleString()}, label {kinds['label'].dataType.simpleString()}, code string, error long"
    if books:
        coded = rows.mapInArrow(assigned(books, dim, scale), out)
    else:
        coded = rows.where(finite(F.col("vector"))).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = settle(
        coded.select(
            "id", "code", "error",
            F.coalesce(F.col("label").cast("string"), F.lit("")).alias("key"), F.col("label").isNull().alias("none"),
        ),
        "codes",
    )
    known = F.count(F.lit(1)) == F.count("error")
    sums = settle(
        coded.groupBy("key", "none")
        .agg(F.when(known, F.sum(F.col("error").cast("decimal(20,0)")).try_cast("long")).alias("label_error"), F.count(F.lit(1)).alias("size")),
        "labels",
    )
    full = attach(coded, sums, ["key", "none"], "size", coded.count())
    return full.select("id", "code", "error", "label_error"), books


def books_sha256(books: list[np.ndarray]) -> str:
    told = ",".join(str(int(x)) for book in books for entry in book for x in entry)
    return hashlib.sha256(told.encode()).hexdigest()

"""Packing of tokenized texts into sequences: dominance reduction, then best fit.

Lengths are at most the sequence length, so the whole instance is a count for each length and the
plan is made from those counts.  Reduction by Martello and Toth: for the longest item left, a set of
at most three items that provably dominates every other set holding that item is fixed for good, as
often as the counts allow.  What no rule settles is packed best-fit decreasing, also by counts.

Pieces then find their place by rank among pieces of their length.  Ranks need no shuffle of a hot
length: a task numbers its own pieces, and only its counts by length meet those of other tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.bpe import codec
from leafmill.llm.common import texts_of
from leafmill.scratch import settle

Plan = list[tuple[int, list[tuple[int, int]]]]
"""(how often, [(length, how many)]): so many sequences hold so many pieces of those lengths."""


def values_below(n: np.ndarray, most: int) -> np.ndarray:
    return np.flatnonzero(n[: most + 1] > 0) if most > 0 else np.empty(0, np.int64)


def smallest(n: np.ndarray, beyond: int, k: int) -> list[int]:
    """The k smallest items greater than ``beyond``, repeated ones included."""
    out: list[int] = []
    for v in np.flatnonzero(n[beyond + 1 :] > 0)[:k] + beyond + 1:
        out += [int(v)] * int(min(n[v], k))
    return out[:k]


def best_pair(n: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two items a >= b with the largest sum that fits."""
    v = values_below(n, room)
    if not len(v):
        return None
    at = np.searchsorted(v, np.minimum(v, room - v), side="right") - 1
    at = np.where((at >= 0) & (v[at] == v) & (n[v] < 2), at - 1, at)
    fits = at >= 0
    if not fits.any():
        return None
    a, b = v[fits], v[at[fits]]
    i = int(np.argmax(a + b))
    return int(a[i]), int(b[i])


def dominating(n: np.ndarray, j: int, size: int) -> list[int] | None:
    """A set of item ``j`` and at most two of ``n`` that dominates all others, if a rule gives one."""
    room = size - j
    low = smallest(n, 0, 3)
    if not low or low[0] > room:
        return [j]  # nothing fits beside it
    star = int(values_below(n, room)[-1])
    if len(low) < 2 or low[0] + low[1] > room or star == room:
        return [j, star]  # one item at most fits, or the largest fills the rest
    if len(low) == 3 and sum(low) <= room:
        return None  # three may fit: no rule
    a, b = best_pair(n, room)
    if star >= a + b:
        return [j, star]
    above = smallest(n, b, 2)
    if a == star and (len(above) < 2 or sum(above) > room):
        return [j, a, b]  # no pair has both items larger
    return None


def reduce(n: np.ndarray, size: int) -> Plan:
    """Fix dominating sets and take them from the counts ``n``, until no rule applies."""
    fixed: Plan = []
    while True:
        before = len(fixed)
        for j in range(size, 0, -1):
            while n[j] > 0:
                n[j] -= 1
                chosen = dominating(n, j, size)
                n[j] += 1
                if chosen is None:
                    break
                need = {v: chosen.count(v) for v in chosen}
                m = min(int(n[v]) // c for v, c in need.items())
                for v, c in need.items():
                    n[v] -= m * c
                fixed.append((m, list(need.items())))
        if len(fixed) == before:
            return fixed


def best_fit(n: np.ndarray, size: int) -> Plan:
    """Best-fit decreasing by counts: each item goes to the fullest sequence with room for it."""
    open_: list[Plan] = [[] for _ in range(size + 1)]
    for v in range(size, 0, -1):
        left = int(n[v])
        while left:
            room = next((r for r in range(v, size) if open_[r]), size)
            many, held = open_[room].pop() if room < size else (left, [])
            each = min(room // v, left)
            m = min(many, left // each)
            open_[room - each * v].append((m, [*held, (v, each)]))
            if room < size and many > m:
                open_[room].append((many - m, held))
            left -= m * each
    return [group for groups in open_ for group in groups]


def plan_table(plan: Plan) -> np.ndarray:
    """Rows (length, first rank, first sequence, number in a sequence, offset), sorted."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for m, held in plan:
        offset = 0
        for v, c in held:
            rows.append((v, used.get(v, 0), sequence, c, offset))
            used[v] = used.get(v, 0) + m * c
            offset += v * c
        sequence += m
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces_of(
    docs: DataFrame, tokenizer: str, size: int, end_id: int, with_ids: bool,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, local[, ids]): tokenized, ended and cut texts.

    ``local`` numbers the pieces of a length within the task ``part``.
    """
    piece = "piece:int,start:long,length:long,ids_crc32:long,part:int,local:long"
    piece += ",ids:array<int>" if with_ids else ""

    @F.pandas_udf(f"array<struct<{piece}>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, part = codec(tokenizer), TaskContext.get().partitionId()
        used = [0] * (size + 1)
        for batch in batches:
            texts, out = batch.tolist(), []
            for flat, ends in own.encoded(texts):
                begin = 0
                for end in ends.tolist():
                    ids = np.append(flat[begin:end], end_id).astype("<u4")
                    begin = end
                    pieces = []
                    for k, start in enumerate(range(0, len(ids), size)):
                        held = ids[start : start + size]
                        n = len(held)
                        row = (k, start, n, zlib.crc32(held.tobytes()), part, used[n])
                        pieces.append(row + ((held.astype(np.int32).tolist(),) if with_ids else ()))
                        used[n] += 1
                    out.append(pieces)
            yield pd.Series(out)
        own.rest()

    rows = texts_of(docs, id_col, text_col)
    return rows.select("id", F.explode(cut("text")).alias("p")).select("id", "p.*")


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 2048,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: (id, piece, start, length, ids_crc32, sequence_id, offset[, ids]).

    A text is its token ids and ``end_id``; one longer than ``size`` is cut into pieces of that size
    and a rest.  A null or empty text is ``end_id`` alone.  Repeated rows and null ids are packed
    like any others; an empty table gives no rows; other columns are ignored.  The driver sees one
    count for each length, ``size`` at most.
    """
    pieces = settle(pieces_of(docs, tokenizer, size, end_id, with_ids, id_col, text_col), "pieces")
    counts = settle(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    n = np.zeros(size + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        n[row["length"]] = row["n"]
    table = plan_table(reduce(n, size) + best_fit(n, size))
    held = docs.sparkSession.sparkContext.broadcast(table)

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = settle(
        counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")),
        "ranks",
    )

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        t = held.value
        v, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted((t[:, 0] << 48) + t[:, 1], (v << 48) + r, side="right") - 1
        k = r - t[at, 1]
        return pd.DataFrame(
            {"sequence_id": t[at, 2] + k // t[at, 3], "offset": t[at, 4] + k % t[at, 3] * v}
        )

    placed = pieces.join(first, ["part", "length"]).withColumn(
        "place", place("length", F.col("first") + F.col("local"))
    )
    return placed.select(
        "id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset",
        *(["ids"] if with_ids else []),
    )

"""Near-duplicates by SimHash fingerprints, compared bit-sliced.

Fingerprints are cut into six blocks.  Two that differ in at most three bits agree on three whole
blocks, so each of the 20 choices of three blocks is a table of buckets, and every link lies in a
bucket of some table.  Equal fingerprints are one row from the start.

Inside a bucket bits are stored vertically: plane k holds bit k of 64 fingerprints in one word, so one
exclusive-or compares 64 of them.  Carry-save counters add the planes up to two bits; a third carry
marks lanes that are beyond the radius, and a block whose lanes are all marked is abandoned.  Buckets
give no pairs but a spanning forest: at most one row for each member.

A bucket of over ``BUCKET`` members is cut again: what its members have not agreed on yet is split
into six blocks, of which a link leaves three untouched.  Members of such a second bucket agree on 46
bits or more, so they are at most 2^18, whatever the table holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from leafmill.llm.common import attach, only, texts_of
from leafmill.llm.linkage import components
from leafmill.scratch import settle

WORDS, RADIUS, SEED = 3, 3, 42
BLOCKS = 2 * RADIUS
BUCKET = 1 << 14
TILE = 1 << 9  # so many fingerprints are compared with a block of so many words at once
CHUNK = 1 << 13
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
LOWERED = bytes.maketrans(UPPER, LOWER)
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, words: int = WORDS) -> int:
    """Bit by bit the majority of the shingles' hashes, as an unsigned number."""
    ws = text.encode().translate(LOWERED).split()  # bytes split at ASCII white space only
    if not ws:
        return 0
    runs = max(len(ws) - words + 1, 1)
    line = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[:runs].tolist()
    stops = ends[min(words, len(ws)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    count = np.zeros(64, np.int64)
    for k in range(0, runs, CHUNK):  # a very long text has bounded arrays
        pairs = zip(starts[k : k + CHUNK], stops[k : k + CHUNK], strict=True)
        h = np.fromiter((digest(line[a:b], SEED) for a, b in pairs), "<u8", min(CHUNK, runs - k))
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > runs, bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64))


def choices(places: list[int]) -> list[int]:
    """Masks of three of the six blocks that ``places`` are cut into, one for each choice."""
    at = [round(k * len(places) / BLOCKS) for k in range(BLOCKS + 1)]
    blocks = [sum(1 << p for p in places[a:b]) for a, b in zip(at, at[1:], strict=False)]
    return [sum(some) for some in combinations(blocks, BLOCKS - RADIUS)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


FIRST = choices(list(range(64)))
SECOND = [[m | x for x in choices([p for p in range(64) if not m >> p & 1])] for m in FIRST]


def first_buckets(prints: DataFrame) -> DataFrame:
    """(part, key, fp): each fingerprint in one bucket of every first table."""
    masks = F.array(*[F.lit(signed(m)) for m in FIRST])
    return prints.select("fp", F.posexplode(masks).alias("part", "mask")).select(
        "part", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"
    )


def second_buckets(rows: DataFrame) -> DataFrame:
    """The same for members of too large a bucket, over the tables below its own."""
    masks = F.array(*[F.array(*[F.lit(signed(m)) for m in own]) for own in SECOND])
    return rows.select(
        "part", "fp", F.posexplode(F.element_at(masks, F.col("part") + 1)).alias("sub", "mask")
    ).select(
        ((F.col("part") + 1) * len(FIRST) + F.col("sub")).alias("part"),
        F.col("fp").bitwiseAND(F.col("mask")).alias("key"),
        "fp",
    )


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes: (64, words), lane i of a plane in bit i % 64 of word i // 64."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    lanes = np.zeros((64, -(-len(fps) // 64) * 64), np.uint8)
    lanes[:, : len(fps)] = bits.T
    return np.packbits(lanes, axis=1, bitorder="little").view("<u8")


def within(a: np.ndarray, b: np.ndarray, dead: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Lanes of planes ``a`` and ``b`` (broadcast) whose distance is ``radius`` or less, of those not dead.

    ``radius`` is 2^n - 1: the carry out of n counter bits says that a lane is beyond it.
    """
    counters = [np.zeros_like(dead) for _ in range(radius.bit_length())]
    for k in range(len(a)):
        carry = a[k] ^ b[k]
        for c in counters:
            both = c & carry
            c ^= carry
            carry = both
        dead |= carry
        if k % 8 == 7 and (dead == ALL).all():
            break
    return ~dead


def lanes_of(live: np.ndarray) -> np.ndarray:
    """Positions of set lanes in the last axis of words, flattened in order."""
    return np.flatnonzero(np.unpackbits(np.ascontiguousarray(live).view(np.uint8), bitorder="little"))


def padding(n: int) -> np.ndarray:
    """Words whose lanes at n and beyond are set."""
    off = np.ones(-(-n // 64) * 64, np.uint8)
    off[:n] = 0
    return np.packbits(off, bitorder="little").view("<u8")


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member it is connected to), for those that aren't the smallest themselves."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all():
            break
    at = np.flatnonzero(label != np.arange(n))
    return at, label[at]


def linked_in(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A forest over one large bucket: tiles of queries against blocks of 64 x TILE lanes."""
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    n, lanes = len(fps), 64 * 64
    order = [k for k in range(64) if len(np.unique(fps >> np.uint64(k) & np.uint64(1))) > 1]
    for start in range(0, n, lanes):
        block = fps[start : start + lanes]
        sliced = planes(block)[order]
        off = padding(len(block))
        for q in range(0, min(start + lanes, n), TILE):
            some = fps[q : q + TILE]
            ask = np.stack([(some >> np.uint64(k) & np.uint64(1)) * ALL for k in order]) if order else np.zeros((0, len(some)), np.uint64)
            live = within(sliced[:, None, :], ask[:, :, None], np.tile(off, (len(some), 1)), radius)
            width = live.shape[1] * 64
            hit = lanes_of(live)
            x, y = q + hit // width, start + hit % width
            a.append(x[x < y])
            b.append(y[x < y])
        if sum(map(len, a)) > 1 << 21:  # a forest is enough of what was found
            kept = forest(n, np.concatenate(a), np.concatenate(b))
            a, b = [kept[0]], [kept[1]]
    return forest(n, np.concatenate(a), np.concatenate(b))


def linked_side_by_side(fps: np.ndarray, run: np.ndarray, size: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A forest over many small buckets that lie one after the other (``run`` numbers them).

    For each distance s, lane i holds fingerprint i against fingerprint i + s of the same bucket.
    """
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    for s in range(1, int(size.max(initial=0))):
        at = np.flatnonzero(run[:-s] == run[s:]) if s < len(run) else np.empty(0, np.int64)
        for k in range(0, len(at), 1 << 16):
            some = at[k : k + (1 << 16)]
            live = within(planes(fps[some]), planes(fps[some + s]), padding(len(some)), radius)
            hit = lanes_of(live)
            a.append(some[hit])
            b.append(some[hit] + s)
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(len(fps), np.concatenate(a), np.concatenate(b))


def links_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (part, key, fp) sorted by part and key to links (a, b): a forest for each bucket."""

    def told(fps: np.ndarray, ends: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame({"a": fps[ends[0]].view(np.int64), "b": fps[ends[1]].view(np.int64)})

    def work(part: np.ndarray, key: np.ndarray, fps: np.ndarray) -> Iterator[pd.DataFrame]:
        new = np.append(True, (part[1:] != part[:-1]) | (key[1:] != key[:-1]))[: len(fps)]
        run = np.cumsum(new) - 1
        size = np.bincount(run)[run] if len(run) else run
        small = (size > 1) & (size <= 64)
        yield told(fps[small], linked_side_by_side(fps[small], run[small], size[small]))
        for first in np.flatnonzero(new & (size > 64)):
            bucket = fps[first : first + size[first]]
            yield told(bucket, linked_in(bucket))

    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        last = frame.iloc[-1]
        first = held[0].iloc[0]
        if (first["part"], first["key"]) == (last["part"], last["key"]):
            continue  # still inside one bucket, which has a bound
        rows = pd.concat(held)
        tail = (rows["part"] == last["part"]) & (rows["key"] == last["key"])
        done = rows[~tail]
        yield from work(done["part"].to_numpy(), done["key"].to_numpy(), done["fp"].to_numpy().view(np.uint64))
        held = [rows[tail]]
    if held:
        rows = pd.concat(held)
        yield from work(rows["part"].to_numpy(), rows["key"].to_numpy(), rows["fp"].to_numpy().view(np.uint64))


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints which differ in three bits or fewer."""
    rows = first_buckets(prints)
    large = settle(
        rows.groupBy("part", "key").count().where(F.col("count") > bucket).select(F.struct("part", "key").alias("at")), "large"
    )
    if large.isEmpty():
        rest = rows
    else:
        tagged = rows.withColumn("at", F.struct("part", "key"))
        cut = only(tagged, large, "at").select("part", "key", "fp")
        rest = without(tagged, large).select("part", "key", "fp").unionByName(second_buckets(cut))
    sorted_ = rest.repartition("part", "key").sortWithinPartitions("part", "key")
    return sorted_.mapInPandas(links_of, "a long, b long").distinct()


def without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows in no large bucket.  Large buckets are fewer than 20 n / BUCKET; broadcast up to a bound."""
    few = keys.count() <= 1 << 18
    return rows.join(F.broadcast(keys) if few else keys, "at", "left_anti")


def simhash_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket: int = BUCKET,
) -> DataFrame:
    """One row per input row: (id, fingerprint, component_id).

    Words are runs of anything but ASCII white space, A-Z lower-cased; a fingerprint bit is set if it is
    in over half the XXH64 hashes of the text's runs of three words, repeats included.  A text of fewer
    words is one run, and a null, empty or blank one has fingerprint zero, which links like any other.
    ``component_id`` is the smallest id of all rows connected by links of three bits or fewer; a row
    with a null id is connected like any other but gives no component its id, so it is null where all
    are.  Rows with the same id are nodes of their own.  Texts of any length are read as a whole, an empty
    table gives no rows, and other columns are ignored.
    """
    rows = settle(texts_of(docs, id_col, text_col).select("id", fingerprints("text").alias("fp")), "fingerprints")
    groups = settle(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("size")), "prints")
    found = settle(links(groups.select("fp"), bucket), "links")
    if found.isEmpty():
        whole = groups.withColumn("component", F.col("least"))
    else:
        label = components(found).select(F.col("id").alias("fp"), "label")
        named = groups.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
        named = settle(named, "labelled")
        least = named.groupBy("label").agg(F.min("least").alias("component"), F.count(F.lit(1)).alias("prints"))
        least = settle(least, "components")
        whole = attach(named, least, ["label"], "prints", named.count())
    whole = settle(whole.select("fp", "size", "component"), "whole")
    return attach(rows, whole, ["fp"], "size", rows.count()).select(
        "id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )

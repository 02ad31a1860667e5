"""Exact de-duplication in two Bloom passes: only hashes that may repeat are shuffled.

Pass one sets, for each text's hash, two slots of a filter that counts to two.  Each task fills its
own part and hands out touched blocks only; blocks are merged by block number.  Pass two probes: a
hash with a slot below two occurs once, and its row passes straight through.  The others, repeated
hashes and a few false positives, are grouped by the full SHA-256.

The filter is broadcast, so its size is bounded: beyond ``max_filter_bytes`` hashes are dealt to
several segments, each with a filter of that size, and each segment's fingerprints are read alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import attach, texts_of
from leafmill.scratch import scratch, settle

BLOCK_BITS = 15  # a block has 2^15 slots: 4 KB for "seen" and 4 KB for "seen twice"
BLOCK = 1 << BLOCK_BITS


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rid_col: str | None = None
) -> DataFrame:
    """(rid, id, sha, n_chars, h): the digest of each text without ASCII white space."""
    rows = texts_of(docs, id_col, text_col, rid_col)
    bare = F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")
    return rows.select(
        "rid",
        "id",
        F.unhex(F.sha2(bare.cast("binary"), 256)).alias("sha"),
        F.char_length("text").cast("long").alias("n_chars"),
    ).withColumn("h", F.xxhash64("sha"))


def slots_of(h: np.ndarray, n_slots: int) -> np.ndarray:
    """Two slots for each hash, one column each."""
    u = h.astype(np.int64).view(np.uint64)
    mask = np.uint64(n_slots - 1)
    return np.stack([u & mask, (u >> np.uint64(32)) & mask], axis=1).astype(np.int64)


def count_slots(n_slots: int):
    """Per task: the slots that its rows touch once, and twice or more, by block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once: np.ndarray = np.empty(0, np.int64)
        twice: np.ndarray = np.empty(0, np.int64)
        for df in batches:
            pos = slots_of(df["h"].to_numpy(), n_slots)
            # a hash whose two slots coincide touches that slot once
            flat = np.concatenate([pos[:, 0], pos[pos[:, 0] != pos[:, 1], 1]])
            slot, n = np.unique(flat, return_counts=True)
            twice = np.union1d(np.union1d(twice, slot[n > 1]), np.intersect1d(once, slot))
            once = np.union1d(once, slot)
        again = np.isin(once, twice, assume_unique=True)
        blocks = once >> BLOCK_BITS
        edges = np.append(np.flatnonzero(np.diff(blocks, prepend=-1)), len(once))
        out = []
        for a, b in zip(edges, edges[1:], strict=False):
            part, rep = once[a:b] & (BLOCK - 1), again[a:b]
            out.append((int(blocks[a]), part.astype("<u2").tobytes(), np.packbits(rep).tobytes()))
            if len(out) == 2000:
                yield pd.DataFrame(out, columns=["block", "slots", "again"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["block", "slots", "again"])

    return run


def merge_block(df: pd.DataFrame) -> pd.DataFrame:
    """All tasks' slots of a block: those that two rows touch, as a bitmap."""
    n = np.zeros(BLOCK, np.uint8)
    for slots, again in zip(df["slots"], df["again"], strict=True):
        part = np.frombuffer(slots, "<u2")
        rep = np.unpackbits(np.frombuffer(again, np.uint8), count=len(part))
        n[part] = np.minimum(n[part] + 1 + rep, 2)
    return pd.DataFrame({"block": [int(df["block"].iloc[0])], "bits": [np.packbits(n == 2).tobytes()]})


def repeated_filter(prints: DataFrame, n_slots: int) -> np.ndarray:
    """Pass one: the bitmap of slots that are touched twice; n_slots / 8 bytes."""
    parts = prints.select("h").mapInPandas(
        count_slots(n_slots), "block long, slots binary, again binary"
    )
    blocks = parts.groupBy("block").applyInPandas(merge_block, "block long, bits binary")
    bits = np.zeros(max(n_slots, BLOCK) // 8, np.uint8)
    for row in blocks.toLocalIterator():
        at = row["block"] * (BLOCK // 8)
        bits[at : at + BLOCK // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def may_repeat(prints: DataFrame, bits: np.ndarray, n_slots: int) -> DataFrame:
    """Pass two: ``prints`` with a column ``maybe``, false where the hash surely occurs once."""
    held = prints.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def probe(h: pd.Series) -> pd.Series:
        pos = slots_of(h.to_numpy(), n_slots)
        hit = (held.value[pos >> 3] >> (7 - (pos & 7)).astype(np.uint8)) & 1
        return pd.Series(hit.all(axis=1))

    return prints.withColumn("maybe", probe("h"))


def exact_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = 16,
    max_filter_bytes: int = 32 << 20,
    rid_col: str | None = None,
) -> DataFrame:
    """One row per input row: (rid, id, keep_id, group_size, kept, text_sha256).

    Texts are equal if identical without ASCII white space.  The row with the most code points
    stays, then the smallest id (null last), then the first of identical rows.  Null texts are
    empty and equal each other; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    path = scratch(spark, "fingerprints")
    fingerprints(docs, id_col, text_col, rid_col).write.parquet(path)
    n_rows = spark.read.parquet(path).count()
    segments = max(1, -(-n_rows * bits_per_row // 8 // max_filter_bytes))
    prints = spark.read.parquet(path)
    if segments > 1:
        dealt = scratch(spark, "segments")
        prints.withColumn("seg", F.expr(f"pmod(shiftright(h, 20), {segments})")).write.partitionBy(
            "seg"
        ).parquet(dealt)
        parts = [spark.read.schema(prints.schema).parquet(f"{dealt}/seg={i}") for i in range(segments)]
    else:
        parts = [prints]
    n_slots = BLOCK
    while n_slots * segments < n_rows * bits_per_row:
        n_slots *= 2
    probed = None
    for part in parts:
        seen = may_repeat(part, repeated_filter(part, n_slots), n_slots)
        probed = seen if probed is None else probed.unionByName(seen)
    probed = settle(probed, "probed")

    group = probed.where("maybe").groupBy("sha")
    groups = settle(
        group.agg(
            F.count(F.lit(1)).alias("group_size"),
            F.min(F.struct(-F.col("n_chars"), F.col("id").isNull(), "id", "rid")).alias("first"),
        ).select(
            "sha",
            "group_size",
            F.col("first.id").alias("keep_id"),
            F.col("first.rid").alias("keep_rid"),
        ),
        "groups",
    )
    alone = probed.where("not maybe").select(
        "rid", "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha",
    )
    shared = attach(probed.where("maybe"), groups, ["sha"], "group_size", n_rows).select(
        "rid", "id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "sha"
    )
    return alone.unionByName(shared).select(
        "rid", "id", "keep_id", "group_size", "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )

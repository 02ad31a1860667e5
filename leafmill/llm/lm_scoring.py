"""Language-model scores from a log-frequency Bloom filter, and exact smoothed word scores.

Words and word pairs of the training texts are counted; a count is quantised to a level on a log
scale, and an n-gram of level q is put into the filter as the q items (n-gram, 1) .. (n-gram, q).
Probing levels upwards until one is missing gives back the level, never a lower one.  The filter is
split by hash into shards: counts of a shard are merged and set in one task, and no two shards
share bits.  Its size follows the training tokens at any size.  What is broadcast is bounded: beyond
``max_bits`` the shards are dealt to segments, each text sends the hashes of its distinct n-grams to
their segments, one segment at a time is broadcast and probed, and the levels are joined back to the
text.  Scores are those of the whole filter.

The exact word counts of the base score never meet in one place.  Words of the most frequent levels,
at most ``HOT_WORDS``, are broadcast; of the others each text sends one row per distinct word to a
join on the word, in which no key is hot.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from math import log10

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.bpe import slices
from leafmill.llm.common import bucket_of, numbered, release, texts_of
from leafmill.scratch import scratch, settle

COUNT_CHARS = 8 << 20
SCORE_CHARS = 2 << 20
HOT_WORDS = 1 << 18
PROBES = 3
LEAST_BITS = 1 << 20
END = b""  # no word is empty
START = np.uint64(0x51_7C_C1_B7_27_22_0A_95)
PAIR = np.uint64(0x9E_37_79_B9_7F_4A_7C_15)
FLAT = 0.1
SCORED = (
    "n_tokens long, hot_known long, hot_score double, score double, "
    "c1 array<long>, c2 array<long>, times array<long>"
)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Tokens:
    """Tokens of some texts: ``word`` numbers them, ``h1`` and ``h2`` are the hashes by number."""

    def __init__(self, texts: list[str]):
        number = defaultdict(count().__next__)
        number[END]
        by_text = []
        for t in texts:  # bytes.lower() and bytes.split() know ASCII letters and white space only
            words = [*t.encode().lower().split(), END]
            by_text.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        self.size = np.fromiter(map(len, by_text), np.int64, len(by_text))
        self.word = np.concatenate(by_text).astype(np.int64)
        digests = b"".join(map(xxhash.xxh3_128_digest, number))
        both = np.frombuffer(digests, "<u8").reshape(-1, 2)
        self.h1, self.h2 = both[:, 0].copy(), both[:, 1].copy()
        self.ends = np.cumsum(self.size)

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each token, of its predecessor and of the pair; a text starts after START."""
        cur = mix(self.h1[self.word])
        before = np.empty_like(cur)
        before[1:] = cur[:-1]
        before[np.append(0, self.ends[:-1])] = START
        return cur, before, mix(before * PAIR + cur)


def word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        texts = df["text"].tolist()
        for some in slices(texts, COUNT_CHARS):
            t = Tokens(texts[some])
            n = np.bincount(t.word, minlength=len(t.h1))
            yield pd.DataFrame({"h1": t.h1.view(np.int64), "h2": t.h2.view(np.int64), "n": n})


def gram_counts(shards: int):
    """Rows (shard, hashes, counts) for words and pairs, distinct within some texts."""
    shift = np.uint64(64 - (shards - 1).bit_length()) if shards > 1 else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            texts = df["text"].tolist()
            for some in slices(texts, COUNT_CHARS):
                cur, _, pair = Tokens(texts[some]).grams()
                h, n = np.unique(np.concatenate([cur, pair]), return_counts=True)
                shard = (h >> shift).astype(np.int64) if shift is not None else np.zeros(len(h), np.int64)
                first = np.flatnonzero(np.diff(shard, prepend=-1))
                edges = np.append(first, len(h))
                n = n.astype("<u4")
                yield pd.DataFrame(
                    {
                        "shard": shard[first],
                        "hashes": [h[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)],
                        "counts": [n[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)],
                    }
                )

    return run


def positions(h: np.ndarray, level: int, bits: int) -> Iterator[np.ndarray]:
    """Where the item (n-gram, level) is kept in a shard of so many bits."""
    x = mix(h + np.uint64(level * int(PAIR) % (1 << 64)))
    step = mix(x) | np.uint64(1)
    for i in range(PROBES):
        yield (x + np.uint64(i) * step) & np.uint64(bits - 1)


def shard_bits(bits: int):
    """Per shard: merge counts, quantise them to levels and set their bits."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        h = np.frombuffer(b"".join(df["hashes"]), np.uint64)
        n = np.frombuffer(b"".join(df["counts"]), "<u4").astype(np.int64)
        h, at = np.unique(h, return_inverse=True)
        level = 1 + np.floor(np.log2(np.bincount(at, n))).astype(np.int64)
        held = np.zeros(bits, np.uint8)
        for q in range(1, int(level.max()) + 1):
            for p in positions(h[level >= q], q, bits):
                held[p.astype(np.int64)] = 1
        return pd.DataFrame(
            {"shard": [int(df["shard"].iloc[0])], "bits": [np.packbits(held, bitorder="little").tobytes()]}
        )

    return run


def middle(level: np.ndarray) -> np.ndarray:
    """The middle of the count range of each level; 0 for level 0."""
    return np.where(level > 0, (3.0 * 2.0**level / 2 - 1) / 2, 0.0)


class Filter:
    """The filter as it is broadcast: of its ``shards``, as many as ``held`` has, from ``first`` on."""

    def __init__(self, held: np.ndarray, shards: int, bits: int, first: int = 0):
        self.held, self.shards, self.bits, self.first = held, shards, bits // shards, first

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The level of each n-gram; 0 if it isn't in the filter."""
        bits = self.bits
        base = np.zeros(len(h), np.int64)
        if self.shards > 1:
            shard = (h >> np.uint64(64 - (self.shards - 1).bit_length())).astype(np.int64)
            base = (shard - self.first) * (bits // 8)
        level = np.zeros(len(h), np.int64)
        alive, q = np.arange(len(h)), 0
        while len(alive) and q < 63:
            q += 1
            here, at = h[alive], base[alive]
            there = np.ones(len(alive), bool)
            for p in positions(here, q, bits):
                byte = self.held[at + (p >> np.uint64(3)).astype(np.int64)]
                there &= (byte >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
            alive = alive[there]
            level[alive] = q
        return level

    def counts(self, h: np.ndarray) -> np.ndarray:
        """The middle of the count range of each n-gram's level; 0 if it isn't in the filter."""
        return middle(self.levels(h))


class Layout:
    """How large the filter of so many tokens is, about four bits for each, and how it is cut."""

    def __init__(self, tokens: int, max_bits: int, partitions: int):
        self.bits = LEAST_BITS
        while self.bits < 4 * tokens:
            self.bits *= 2
        self.segments = 1
        while self.bits // self.segments > max(max_bits, 512):
            self.segments *= 2
        self.shards = self.segments
        while self.shards < max(4 * partitions, tokens >> 22) and self.bits // self.shards > 512:
            self.shards *= 2
        self.each = self.shards // self.segments


def layout(spark: SparkSession, tokens: int, max_bits: int) -> Layout:
    return Layout(tokens, max_bits, int(spark.conf.get("spark.sql.shuffle.partitions")))


def segment_filters(train: DataFrame, at: Layout) -> Iterator[Filter]:
    """The filter of all words and pairs of ``train``, one segment after the other."""
    spark = train.sparkSession
    rows = train.select("text").mapInPandas(
        gram_counts(at.shards), "shard long, hashes binary, counts binary"
    )
    made = rows.groupBy("shard").applyInPandas(shard_bits(at.bits // at.shards), "shard long, bits binary")
    path = scratch(spark, "filter")
    made.withColumn("seg", F.expr(f"shard div {at.each}")).write.partitionBy("seg").parquet(path)
    table = spark.read.schema("shard long, bits binary, seg long").parquet(path)
    width = at.bits // 8 // at.shards
    for seg in range(at.segments):
        held = np.zeros(width * at.each, np.uint8)
        for row in table.where(F.col("seg") == seg).toLocalIterator():
            held[(row["shard"] - seg * at.each) * width :][:width] = np.frombuffer(row["bits"], np.uint8)
        yield Filter(held, at.shards, at.bits, seg * at.each)


def build_filter(train: DataFrame, tokens: int, max_bits: int) -> Filter:
    """The whole filter, which has to fit into ``max_bits``."""
    at = layout(train.sparkSession, tokens, max_bits)
    if at.segments > 1:
        raise ValueError("the filter has several segments")
    return next(segment_filters(train, at))


def distinct_grams(cur: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of a text's words and pairs, in order, and the place of each among them."""
    return np.unique(np.concatenate([cur, pair]), return_inverse=True)


def gram_hashes(segments: int):
    """Rows (rid, seg, hashes): the distinct n-grams of each text, by segment."""
    shift = np.uint64(64 - (segments - 1).bit_length())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            texts, rids = df["text"].tolist(), df["rid"].to_numpy()
            for some in slices(texts, SCORE_CHARS):
                t = Tokens(texts[some])
                cur, _, pair = t.grams()
                out = []
                for rid, a, b in zip(rids[some].tolist(), t.ends - t.size, t.ends, strict=True):
                    h, _ = distinct_grams(cur[a:b], pair[a:b])
                    seg = (h >> shift).astype(np.int64)
                    first = np.flatnonzero(np.diff(seg, prepend=-1))
                    for i, j in zip(first, np.append(first[1:], len(h)), strict=True):
                        out.append((rid, int(seg[i]), h[i:j].tobytes()))
                yield pd.DataFrame(out, columns=["rid", "seg", "hashes"])

    return run


def prober(sent):
    @F.pandas_udf("binary")
    def probe(hashes: pd.Series) -> pd.Series:
        ends = np.cumsum([len(x) // 8 for x in hashes])
        level = sent.value.levels(np.frombuffer(b"".join(hashes), np.uint64)).astype(np.uint8)
        return pd.Series([x.tobytes() for x in np.split(level, ends[:-1])], dtype=object)

    return probe


def probed_levels(rows: DataFrame, train: DataFrame, at: Layout) -> DataFrame:
    """(rid, levels): of each text's distinct n-grams in order, a byte each, segment by segment."""
    spark = rows.sparkSession
    path = scratch(spark, "grams")
    rows.select("rid", "text").mapInPandas(gram_hashes(at.segments), "rid long, seg long, hashes binary").write.partitionBy(
        "seg"
    ).parquet(path)
    table = spark.read.schema("rid long, hashes binary, seg long").parquet(path)
    every = None
    for seg, bloom in enumerate(segment_filters(train, at)):
        sent = spark.sparkContext.broadcast(bloom)
        some = table.where(F.col("seg") == seg).select("rid", F.lit(seg).alias("seg"), prober(sent)("hashes").alias("levels"))
        part = settle(some, "levels")
        sent.destroy()
        every = part if every is None else every.union(part)
    parts = F.sort_array(F.collect_list(F.struct("seg", "levels")))
    whole = F.aggregate(parts["levels"], F.lit(b""), lambda a, x: F.concat(a, x))
    return every.groupBy("rid").agg(whole.alias("levels"))


def hot_words(counts: DataFrame, most: int) -> np.ndarray:
    """(h1, h2, n) of the words of the most frequent levels, ``most`` at most, sorted by h1."""
    level = F.floor(4 * F.log2("n")).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect()
    least, left = None, most
    for row in sorted(levels, key=lambda r: -r["level"]):
        if row["words"] > left:
            break
        least, left = row["level"], left - row["words"]
    if least is None:
        return np.empty((0, 3), np.int64)
    held = counts.where(level >= least).select("h1", "h2", "n").toPandas().to_numpy(np.int64)
    return held[np.argsort(held[:, 0].view(np.uint64), kind="stable")]


def told_counts(
    t: Tokens, cur: np.ndarray, pair: np.ndarray, levels: list[bytes]
) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each token and pair from the levels of each text's distinct n-grams."""
    single, both = np.empty(len(cur)), np.empty(len(cur))
    for a, b, told in zip(t.ends - t.size, t.ends, levels, strict=True):
        _, at = distinct_grams(cur[a:b], pair[a:b])
        n = middle(np.frombuffer(told, np.uint8).astype(np.int64))[at]
        single[a:b], both[a:b] = n[: b - a], n[b - a :]
    return single, both


def scorer(filter_of, hot_of, stats: dict[str, float], weight: float):
    """Per text: its model score, the base score of its hot words, and its other words.

    Levels of n-grams come from the whole filter or, without one, from a second column.
    """
    total = stats["tokens"] + FLAT * (stats["words"] + 1)

    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        bloom, hot = filter_of and filter_of.value, hot_of.value
        keys = hot[:, 0].view(np.uint64) if len(hot) else np.empty(0, np.uint64)
        for batch, *more in batches:
            texts, made = batch.tolist(), []
            levels = more[0].tolist() if more else []
            for some in slices(texts, SCORE_CHARS):
                t = Tokens(texts[some])
                at = np.minimum(np.searchsorted(keys, t.h1), max(len(keys) - 1, 0))
                is_hot = np.zeros(len(t.h1), bool)
                n = np.zeros(len(t.h1), np.int64)
                if len(keys):
                    # equal first halves are too rare to matter among hot words, and are then cold
                    is_hot = (keys[at] == t.h1) & (hot[at, 1].view(np.uint64) == t.h2)
                    n = np.where(is_hot, hot[at, 2], 0)
                known = np.add.reduceat(is_hot[t.word].astype(np.int64), t.ends - t.size)
                base = np.where(is_hot, np.log10(n + FLAT), 0.0)
                base = np.add.reduceat(base[t.word], t.ends - t.size)

                cur, before, pair = t.grams()
                if bloom:
                    single, both = bloom.counts(mix(t.h1))[t.word], bloom.counts(pair)
                else:
                    single, both = told_counts(t, cur, pair, levels[some])
                history = np.append(0.0, single[:-1])
                history[t.ends - t.size] = stats["texts"]
                both = np.minimum(both, history)
                p = (both + weight * (single + FLAT) / total) / (history + weight)
                score = np.add.reduceat(np.log10(np.minimum(p, 1.0)), t.ends - t.size)

                text = np.repeat(np.arange(len(t.size)), t.size)
                cold = ~is_hot[t.word]
                code, times = np.unique(text[cold] * len(t.h1) + t.word[cold], return_counts=True)
                owner, word = code // len(t.h1), code % len(t.h1)
                cut = np.searchsorted(owner, np.arange(1, len(t.size)))
                h1, h2 = t.h1.view(np.int64), t.h2.view(np.int64)
                made.append(
                    pd.DataFrame(
                        {
                            "n_tokens": t.size,
                            "hot_known": known,
                            "hot_score": base,
                            "score": score,
                            "c1": np.split(h1[word], cut),
                            "c2": np.split(h2[word], cut),
                            "times": np.split(times.astype(np.int64), cut),
                        }
                    )
                )
            yield pd.concat(made, ignore_index=True)
        release()

    if filter_of:

        @F.pandas_udf(SCORED)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            return score((batch,) for batch in batches)
    else:

        @F.pandas_udf(SCORED)
        def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            return score(batches)

    return run


def lm_scores(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 10,
    held_fold: int = 0,
    weight: float = 20.0,
    max_bits: int = 1 << 31,
    hot: int = HOT_WORDS,
) -> DataFrame:
    """One row per text: (rid, id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Texts whose crc32(id) mod ``folds`` is ``held_fold`` are not learnt from; a null id counts as
    empty text.  Tokens are words with ASCII letters in lower case, then one end.  A null or empty
    text is its end alone.  ``score`` is the log10 probability by word pairs, smoothed towards
    single words with ``weight``; all counts of the model come from the filter.  Without training
    texts every word is as likely.  Repeated rows count and score as often as they occur; an empty
    table gives no rows; other columns are ignored.  Words are told apart by 128-bit hashes.
    ``max_bits`` bounds what is broadcast at once, not the filter.
    """
    spark = docs.sparkSession
    rows = texts_of(docs, id_col, text_col).withColumn(
        "held_out", bucket_of(F.col("id"), folds) == held_fold
    )
    train = rows.where(~F.col("held_out"))
    counts = settle(
        train.select("text")
        .mapInPandas(word_counts, "h1 long, h2 long, n long")
        .groupBy("h1", "h2")
        .agg(F.sum("n").alias("n")),
        "words",
    )
    whole = counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("words")).first()
    end = xxhash.xxh3_128_digest(END)
    e1, e2 = np.frombuffer(end, "<i8").tolist()
    ends = counts.where((F.col("h1") == e1) & (F.col("h2") == e2)).first()
    stats = {"tokens": whole["tokens"] or 0, "words": whole["words"], "texts": ends["n"] if ends else 0}
    send = spark.sparkContext.broadcast
    at = layout(spark, stats["tokens"], max_bits)
    if at.segments == 1:
        bloom, given = send(next(segment_filters(train, at))), ["text"]
    else:
        held, row = numbered(docs, "documents")
        rows = texts_of(held, id_col, text_col, row).withColumn("held_out", bucket_of(F.col("id"), folds) == held_fold)
        rows = rows.join(probed_levels(rows, train, at), "rid")
        bloom, given = None, ["text", "levels"]
    known = send(hot_words(counts, hot))

    scored = settle(
        rows.select("rid", "id", "held_out", scorer(bloom, known, stats, weight)(*given).alias("s")).select(
            "rid", "id", "held_out", "s.*"
        ),
        "scored",
    )
    cold = scored.select("rid", F.explode(F.arrays_zip("c1", "c2", "times")).alias("w")).select(
        "rid", F.col("w.c1").alias("h1"), F.col("w.c2").alias("h2"), "w.times"
    )
    rest = (
        cold.join(counts, ["h1", "h2"], "left")
        .groupBy("rid")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(FLAT))).alias("cold_score"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("cold_known"),
        )
    )
    bottom = log10(stats["tokens"] + FLAT * (stats["words"] + 1))
    return scored.join(rest, "rid", "left").select(
        "rid", "id", "held_out", "n_tokens",
        (F.col("hot_known") + F.coalesce("cold_known", F.lit(0))).alias("n_known"),
        F.lit(stats["tokens"]).cast("long").alias("train_tokens"),
        (F.col("hot_score") + F.coalesce("cold_score", F.lit(0.0)) - F.col("n_tokens") * bottom).alias("base_score"),
        "score",
    )

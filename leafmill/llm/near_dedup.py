"""Near-duplicates by ProbMinHash, banding and verification.

A text's weighted shingles are its runs of five words with their counts.  Each shingle sends points of
a Poisson process, at a rate of its weight, to random registers; a register keeps the shingle whose
point came first, so two texts agree on a register with the probability Jaccard of their shingles.
A shingle stops as soon as its next point comes later than every register of its text.  Texts that
agree on a band of registers are candidates; their shingles are then compared exactly.  A text that
repeats a shingle is also hashed with all weights 1, so that plain Jaccard finds its candidates too; for
any other text both are the same.

Texts with the same words are one group from the start, however many copies there are, and only one of
each takes part in banding.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.bpe import slices
from leafmill.llm.common import attach, only, release, texts_of
from leafmill.llm.linkage import classes
from leafmill.llm.lm_scoring import mix
from leafmill.scratch import settle

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
"""A pair of similarity 0.8 is missed by all bands with probability (1 - 0.8^5)^24 = 8e-5."""
SKETCH = 2048
"""Registers of a candidate's sketch, a bit each: it tells pairs below a similarity of about 0.73 apart."""
SLICE_CHARS = 2 << 20
SLICE_SKETCHES = 256
PRIME = np.uint64(0x9E3779B97F4A7C15)
FEATURES = "e1 long, e2 long, bands array<long>, shingles binary, counts binary"


def shingles(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(text, shingle, count) sorted by text and shingle, and a 128-bit hash of each text's words.

    A text of fewer words has one shingle of them all; one without words has none.
    """
    number = defaultdict(count().__next__)
    by_text, exact = [], []
    for t in texts:  # one text's words at a time: they are many small objects
        ws = t.encode().split()
        by_text.append(np.fromiter(map(number.__getitem__, ws), np.int32, len(ws)))
        exact.append(xxhash.xxh3_128_intdigest(b" ".join(ws)))
    size = np.fromiter(map(len, by_text), np.int64, len(by_text))
    word = np.concatenate([*by_text, np.empty(0, np.int32)])
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))[word]
    begin = np.cumsum(size) - size
    runs = np.where(size == 0, 0, np.maximum(size - words + 1, 1))
    text = np.repeat(np.arange(len(texts)), runs)
    at = np.repeat(begin - (np.cumsum(runs) - runs), runs) + np.arange(int(runs.sum()))
    end = (begin + size)[text]
    x = np.zeros(len(at), np.uint64)
    for k in range(words):
        inside = at + k < end
        more = mix(x * PRIME + h[np.minimum(at + k, max(len(h) - 1, 0))]) if len(h) else x
        x = np.where(inside, more, x)
    order = np.lexsort((x, text))
    text, x = text[order], x[order]
    new = np.append(True, (x[1:] != x[:-1]) | (text[1:] != text[:-1]))[: len(x)]
    first = np.flatnonzero(new)
    return text[first], x[first], np.diff(np.append(first, len(x))), [divmod(e, 1 << 64) for e in exact]


def prob_minhash(text: np.ndarray, x: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """The winning shingle of each register of n texts; all texts and shingles abreast."""
    first = np.full(n * registers, np.inf)
    held = np.zeros(n * registers, np.uint64)
    alive = np.arange(len(x))
    time = np.zeros(len(x))
    latest = np.full(n, np.inf)
    turn = 0
    while len(alive):
        turn += 1
        r = mix(x[alive] + np.uint64(turn * int(PRIME) % (1 << 64)))
        step = -np.log(((r >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53)
        time[alive] += step / weight[alive]
        place = text[alive] * registers + (mix(r) % np.uint64(registers)).astype(np.int64)
        t = time[alive]
        np.minimum.at(first, place, t)
        won = first[place] == t
        held[place[won]] = x[alive[won]]
        open_ = text[alive]  # sorted, as texts are
        some = open_[np.append(True, open_[1:] != open_[:-1])]
        latest[some] = first.reshape(n, registers)[some].max(axis=1)
        alive = alive[t < latest[open_]]
    return held.reshape(n, registers)


def band_keys(held: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.zeros((len(held), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        key = mix(key * PRIME + held[:, r * bands : (r + 1) * bands])
    return key.view(np.int64)


def featurizer(words: int, bands: int, rows: int):
    @F.pandas_udf(FEATURES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, made = batch.tolist(), []
            for some in slices(texts, SLICE_CHARS):
                n = len(texts[some])
                text, x, times, exact = shingles(texts[some], words)
                held = prob_minhash(text, x, times.astype(float), n, bands * rows)
                keys = band_keys(held, bands, rows)
                edge = np.searchsorted(text, np.arange(n + 1))
                again = np.unique(text[times > 1])  # texts that repeat a shingle
                plain_keys = {}
                if len(again):
                    mine = np.isin(text, again)
                    owner = np.searchsorted(again, text[mine])
                    plain = prob_minhash(owner, x[mine], np.ones(len(owner)), len(again), bands * rows)
                    plain_keys = dict(zip(again.tolist(), band_keys(plain, bands, rows), strict=True))
                short = (x >> np.uint64(32)).astype("<u4")
                times = times.astype("<u4")
                for k, (e1, e2) in enumerate(exact):
                    a, b = edge[k], edge[k + 1]
                    key = keys[k] if b > a else []
                    if k in plain_keys:
                        key = np.union1d(key, plain_keys[k])
                    made.append(
                        (
                            e1 - (1 << 63), e2 - (1 << 63), key,
                            short[a:b].tobytes(), times[a:b].tobytes() if (times[a:b] > 1).any() else b"",
                        )
                    )
            yield pd.DataFrame(made, columns=["e1", "e2", "bands", "shingles", "counts"])
        release()

    return run


def similarity(sa: bytes, ca: bytes, sb: bytes, cb: bytes) -> tuple[float, float]:
    """Probability Jaccard by counts, and plain Jaccard, of two texts' shingles."""
    a, b = np.frombuffer(sa, "<u4"), np.frombuffer(sb, "<u4")
    if not len(a) or not len(b):
        return 0.0, 0.0
    wa = np.frombuffer(ca, "<u4") if ca else np.ones(len(a))
    wb = np.frombuffer(cb, "<u4") if cb else np.ones(len(b))
    both = np.concatenate([a, b])
    every, at = np.unique(both, return_inverse=True)
    x = np.bincount(at[: len(a)], wa, minlength=len(every))
    y = np.bincount(at[len(a) :], wb, minlength=len(every))
    common = (x > 0) & (y > 0)
    plain = common.sum() / len(every)
    if not ca and not cb:
        return float(plain), float(plain)
    with np.errstate(divide="ignore"):
        rate = y / x
    order = np.argsort(rate, kind="stable")
    value = rate[order]
    upto = np.searchsorted(value, value, side="right")  # equal rates count on either side alike
    low = np.append(0, np.cumsum(x[order]))[upto]
    high = y.sum() - np.append(0, np.cumsum(y[order]))[upto]
    c = common[order]
    weighted = (1 / (low[c] / x[order][c] + high[c] / y[order][c])).sum()
    return float(weighted), float(plain)


def sketches(held: np.ndarray) -> np.ndarray:
    """One bit of each register, 64 registers to a long."""
    n, registers = held.shape
    bits = np.zeros((n, -(-registers // 64) * 64), np.uint8)
    bits[:, :registers] = (mix(held) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


def sketcher(registers: int):
    """A sketch of counted shingles, followed by one by weights 1 where a shingle is repeated.

    Only texts that share a band get one, so it may be far longer than the bands.
    """

    def winners(xs: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
        text = np.repeat(np.arange(len(xs)), [len(x) for x in xs])
        return sketches(prob_minhash(text, np.concatenate(xs), np.concatenate(weights), len(xs), registers))

    @F.pandas_udf("array<long>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for shingles_of, counts_of in batches:
            made: list[np.ndarray] = []
            for begin in range(0, len(shingles_of), SLICE_SKETCHES):
                here = slice(begin, begin + SLICE_SKETCHES)
                xs = [mix(np.frombuffer(s, "<u4") * PRIME) for s in shingles_of[here]]
                ones = [np.ones(len(x)) for x in xs]
                ws = [np.frombuffer(c, "<u4").astype(float) if c else one for c, one in zip(counts_of[here], ones, strict=True)]
                both = list(winners(xs, ws))
                again = [k for k, c in enumerate(counts_of[here]) if c]
                if again:
                    for k, plain in zip(again, winners([xs[k] for k in again], [ones[k] for k in again]), strict=True):
                        both[k] = np.append(both[k], plain)
                made += both
            yield pd.Series(made)
        release()

    return run


def agree_enough(registers: int, least: float):
    """A condition on two sketches: no more bits differ than ``least`` may explain.

    A sketch may be followed by a second one, by weights 1: one of both measures has to allow it.
    At that similarity the number that differ exceeds the bound, five standard deviations above its
    mean, once in some million pairs; candidates far below it never become rows.
    """
    share = (1 - least) / 2
    bound = int(registers * share + 5 * (registers * share * (1 - share)) ** 0.5)
    longs = -(-registers // 64)

    def differ(a: Column, b: Column, word: Callable[[Column, int], Column]) -> Column:
        total = F.lit(0)
        for k in range(longs):
            total = total + F.bit_count(word(a, k).bitwiseXOR(word(b, k)))
        return total

    def may(a: Column, b: Column) -> Column:
        counted = lambda s, k: F.get(s, F.lit(k))
        plain = lambda s, k: F.coalesce(F.get(s, F.lit(longs + k)), F.get(s, F.lit(k)))
        two = F.greatest(F.size(a), F.size(b)) > longs
        return (differ(a, b, counted) <= bound) | (two & (differ(a, b, plain) <= bound))

    return may


def verifier(least: float):
    """Keep pairs whose probability or plain Jaccard reaches ``least``."""

    @F.pandas_udf("boolean")
    def alike(sa: pd.Series, ca: pd.Series, sb: pd.Series, cb: pd.Series) -> pd.Series:
        return pd.Series([max(similarity(*x)) >= least - 1e-12 for x in zip(sa, ca, sb, cb, strict=True)], dtype=bool)

    def verify(pairs: DataFrame, features: DataFrame) -> DataFrame:
        one = features.select(F.col("id").alias("a"), F.col("shingles").alias("sa"), F.col("counts").alias("ca"))
        two = features.select(F.col("id").alias("b"), F.col("shingles").alias("sb"), F.col("counts").alias("cb"))
        # a text that leads many pairs is a hot key: both joins are ones that Spark can split
        both = pairs.join(one, "a").join(two, "b")
        return both.where(alike("sa", "ca", "sb", "cb")).select("a", "b")

    return verify


def near_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    least: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    rid_col: str | None = None,
) -> DataFrame:
    """One row per text: (rid, id, class_id, group_size, kept).

    Texts are linked if the probability Jaccard of their counted shingles, or the plain Jaccard, is
    ``least`` or more; classes are the connected components.  The text with the smallest id stays
    (null last, then the first of identical rows) and its id is the class.  A text of fewer than
    ``words`` words has one shingle; texts without words, null ones among them, are one class.  An
    empty table gives no rows; other columns are ignored.  Words are runs without ASCII white space.
    ``rid_col`` names a column that numbers the rows, if there is one.
    """
    base = texts_of(docs, id_col, text_col, rid_col)
    made = base.select("rid", "id", featurizer(words, bands, rows)("text").alias("f")).select("rid", "id", "f.*")
    features = settle(made, "features")
    total = features.count()
    groups = settle(
        features.groupBy("e1", "e2").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("rid").alias("rep"),
            F.min(F.struct(F.col("id").isNull(), "id", "rid")).alias("first"),
        ),
        "groups",
    )
    alone = features.select("rid", "bands").join(groups.select(F.col("rep").alias("rid")), "rid", "left_semi")
    members = settle(alone.select(F.explode("bands").alias("bucket"), F.col("rid").alias("id")), "members")

    def contents(ids: DataFrame) -> DataFrame:
        each = only(features.select(F.col("rid").alias("id"), "shingles", "counts"), ids, "id")
        return settle(each.withColumn("sketch", sketcher(SKETCH)("shingles", "counts")), "contents")

    labels = classes(members, contents, agree_enough(SKETCH, least), verifier(least))

    named = settle(
        groups.join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left").withColumn(
            "label", F.coalesce("label", "rep")
        ),
        "named",
    )
    whole = settle(
        named.groupBy("label").agg(
            F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("texts"), F.min("first").alias("stays")
        ),
        "classes",
    )
    told = settle(
        attach(named.select("label", "e1", "e2", "n"), whole, ["label"], "texts", total), "told"
    ).select(
        "e1", "e2", "n", "group_size", F.col("stays.id").alias("class_id"), F.col("stays.rid").alias("stays")
    )
    return attach(features.select("rid", "id", "e1", "e2"), told, ["e1", "e2"], "n", total).select(
        "rid", "id", "class_id", "group_size", (F.col("rid") == F.col("stays")).alias("kept")
    )

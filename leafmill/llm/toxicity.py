"""Toxic passages by maximum-scoring segments, and a calibrated score of each text.

A word's score is its log-odds between toxic and other training texts under an informative Dirichlet
prior, kept where its z value is significant, minus a constant drift, so that neutral text scores
below zero.  A linear scan finds all maximal segments of a text.  Their scores follow an extreme-value
law: lambda solves sum p(s) exp(lambda s) = 1 over the words of clean texts, and K makes the best
segments of clean training texts as significant as chance would.  A segment whose expected number is
small is a toxic passage; the text's score is a logistic function of its segments' significances.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.bpe import ragged, slices
from leafmill.llm.common import bucket_of, texts_of
from leafmill.scratch import settle

LETTERS = re.compile(r"[^\W\d_]+")
TRAIN_ROWS = 20_000
VOCABULARY = 50_000
SLICE_CHARS = 2 << 20
GRID = np.arange(-8, 8, 0.05)
PASSAGES = "array<struct<start:int,end:int,score:double,expected:double>>"


@dataclass
class Model:
    """Scores of the known words, the extreme-value law, and the weights of the features."""

    words: dict[str, float]
    drift: float
    lam: float = 1.0
    k: float = 1.0
    weights: np.ndarray | None = None
    prior: float = 0.0

    def score(self, word: str) -> float:
        """Of the word, or else of its longest stem that is known."""
        return next((self.words[x] for x in stems(word) if x in self.words), 0.0) - self.drift


def maximal_segments(at: list[int], low: list[float], high: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score) by the linear scan of Ruzzo and Tompa.

    ``at``: positions of positive scores in order; ``low``, ``high``: the sum of scores before and
    through each.  ``back`` leads from a candidate to the nearest one that begins lower.
    """
    segments: list[tuple[int, int, float, float]] = []
    back: list[int] = []
    for i, lo, hi in zip(at, low, high, strict=True):
        begin, end = i, i + 1
        j = len(segments) - 1
        while True:
            while j >= 0 and segments[j][2] >= lo:
                j = back[j]
            if j < 0 or segments[j][3] >= hi:
                break
            begin, lo = segments[j][0], segments[j][2]
            del segments[j:]
            nxt = back[j]
            del back[j:]
            j = nxt
        segments.append((begin, end, lo, hi))
        back.append(j)
    return [(b, e, hi - lo) for b, e, lo, hi in segments]


def stems(word: str) -> list[str]:
    """The word and, longest first, its beginnings that inflected forms share."""
    return [word, *(word[:k] + "*" for k in (6, 5, 4) if len(word) > k)]


def word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per word and stem, the texts of either label that hold it; "" counts all texts."""
    for df in batches:
        texts, toxic = df["text"].tolist(), df["toxic"].to_numpy(bool)
        for some in slices(texts, SLICE_CHARS):
            number, term = (defaultdict(count().__next__) for _ in range(2))
            parts = [[*LETTERS.findall(t.lower()), ""] for t in texts[some]]
            size = np.fromiter(map(len, parts), np.int64, len(parts))
            word = np.fromiter(map(number.__getitem__, chain.from_iterable(parts)), np.int64)
            once = np.unique(np.repeat(np.arange(len(parts)), size) * len(number) + word)
            of = [[term[x] for x in stems(w)] for w in number]
            length = np.fromiter(map(len, of), np.int64, len(of))
            flat = np.fromiter(chain.from_iterable(of), np.int64)
            text, word = once // len(number), once % len(number)
            at = ragged((np.cumsum(length) - length)[word], length[word])
            held = np.unique(np.repeat(text, length[word]) * len(term) + flat[at])
            label = toxic[some][held // len(term)]
            n = len(term)
            yield pd.DataFrame(
                {
                    "word": list(term),
                    "toxic": np.bincount(held[label] % n, minlength=n),
                    "clean": np.bincount(held[~label] % n, minlength=n),
                }
            )


def features(s: np.ndarray, n: int, model: Model) -> list[float]:
    """Of a text of n words with segments of scores s: best, sum and number of significances."""
    if not len(s):
        return [0.0, 0.0, 0.0, float(np.log1p(n))]
    x = model.lam * s - np.log(model.k * max(n, 1))
    best = float(x.max())
    return [max(best, -5.0) + 5.0, float(np.maximum(x, 0).sum()), float((x > 3).sum()), float(np.log1p(n))]


def scan(
    texts: list[str], model: Model, grid: np.ndarray | None = None
) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """Per text: number of words, and its maximal segments in words; ``grid`` counts their scores."""
    number = defaultdict(count().__next__)
    parts = [LETTERS.findall(t) for t in texts]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    word = np.fromiter(map(number.__getitem__, chain.from_iterable(parts)), np.int64)
    known = np.array([model.score(w.lower()) for w in number], float)
    value = known[word] if len(word) else np.empty(0)
    if grid is not None:
        grid += np.bincount(np.digitize(value, GRID), minlength=len(GRID) + 1)
    through = np.cumsum(value)
    ends = np.cumsum(size)
    plus = np.flatnonzero(value > 0)
    edge = np.searchsorted(plus, np.append(0, ends))
    for k in range(len(texts)):
        begin = int(ends[k] - size[k])
        at = plus[edge[k] : edge[k + 1]]
        if not len(at):
            yield int(size[k]), []
            continue
        high = through[at]
        yield int(size[k]), maximal_segments(
            (at - begin).tolist(), (high - value[at]).tolist(), high.tolist()
        )


def segment_features(model: Model):
    """Of each training text its words and segment scores; on some rows, how clean words score."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            texts = df["text"].tolist()
            for some in slices(texts, SLICE_CHARS):
                toxic = df["toxic"].iloc[some].to_numpy(bool)
                grid = np.zeros(len(GRID) + 1, np.int64)
                for _ in scan([t for t, y in zip(texts[some], toxic, strict=True) if not y], model, grid):
                    pass
                out = [(n, [x[2] for x in found]) for n, found in scan(texts[some], model)]
                made = pd.DataFrame(out, columns=["n", "segments"])
                made["toxic"] = toxic
                made["grid"] = [grid, *[None] * (len(made) - 1)]
                yield made

    return run


def karlin_lambda(score: np.ndarray, p: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1; the mean score is negative."""
    low, high = 0.0, 1.0
    if not ((score > 0) & (p > 0)).any() or (score * p).sum() >= 0:
        return 1.0
    f = lambda x: float((p * np.exp(np.minimum(x * score, 600.0))).sum()) - 1
    while f(high) < 0:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def fit_k(n: np.ndarray, best: np.ndarray, lam: float) -> float:
    """K for which the best segments of clean texts are as significant as chance: mean 1 - P = 1/2."""
    low, high = -30.0, 10.0
    if not len(n):
        return 1.0
    for _ in range(60):
        mid = (low + high) / 2
        mean = np.mean(-np.expm1(-np.exp(mid) * n * np.exp(-lam * best)))
        low, high = (mid, high) if mean < 0.5 else (low, mid)
    return float(np.exp(high))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights by Newton's steps with a small ridge, the last one the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(
    docs: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS, vocabulary: int = VOCABULARY,
    z: float = 3.0, prior: float = 50.0, drift: float = 0.1, folds: int = 4, held_fold: int = 2,
) -> Model:
    """Fit on at most ``rows`` labelled texts, of as many ids, chosen by hash, outside the held-out fold.

    ``docs`` is (id, text), ``labels`` has doc_id and toxic; of several labels of an id the largest
    counts, null labels don't.  At most ``vocabulary`` words are kept, by z value.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).na.drop()
    chosen = (
        known.where(bucket_of(F.col("id"), folds) != held_fold)
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id").limit(rows)
    )
    found = docs.join(F.broadcast(chosen), "id").select("id", "text", (F.col("toxic") > 0).alias("toxic"))
    texts = settle(found.withColumn("h", F.xxhash64("id", "text", F.monotonically_increasing_id())), "labelled")
    if texts.count() > rows:  # an id may have any number of rows: the bound is on texts too
        last = texts.select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
        texts = texts.where(F.col("h") <= last)
    texts = texts.select("text", "toxic")
    counts = settle(
        texts.mapInPandas(word_counts, "word string, toxic long, clean long")
        .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "words",
    )
    whole = counts.where("word = ''").first()
    if whole is None:
        return Model({}, drift)
    n1, n0 = whole["toxic"], whole["clean"]
    if not n1 or not n0:
        return Model({}, drift, prior=1.0 if n1 else 0.0)
    a = prior * (F.col("toxic") + F.col("clean")) / (n1 + n0)
    t, c = F.col("toxic") + a, F.col("clean") + a
    odds = F.log(t / (n1 + 2 * prior - t)) - F.log(c / (n0 + 2 * prior - c))
    scored = counts.where("word != '' and toxic + clean >= 3").select(
        "word", odds.alias("d"), (odds / F.sqrt(1 / t + 1 / c)).alias("z")
    )
    top = scored.where(F.abs("z") >= z).orderBy(F.desc(F.abs("z")), "word").limit(vocabulary).collect()
    model = Model({r["word"]: float(r["d"]) for r in top}, drift)

    found = texts.mapInPandas(
        segment_features(model), "n long, segments array<double>, toxic boolean, grid array<long>"
    ).toPandas()
    grid = np.sum([g for g in found["grid"] if g is not None], axis=0).astype(float)
    highest = max(model.words.values(), default=0.0) - drift
    grid[np.digitize(max(highest, 0.1), GRID)] += 0.5  # clean texts may hold no such word
    value = np.append(GRID[0], GRID) + 0.025
    model.lam = karlin_lambda(value, grid / grid.sum())
    segments = [np.asarray(s, float) for s in found["segments"]]
    n, y = found["n"].to_numpy(float), found["toxic"].to_numpy(float)
    best = np.array([s.max(initial=0.0) for s in segments])
    clean = (y == 0) & (best > 0)
    model.k = fit_k(n[clean], best[clean], model.lam)
    x = np.array([features(s, int(m), model) for s, m in zip(segments, n, strict=True)])
    model.weights = logistic(x, y)
    return model


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 4,
    held_fold: int = 2,
    threshold: float = 0.3,
    expected: float = 0.05,
    **fit: float,
) -> DataFrame:
    """One row per text: (id, held_out, score, predicted, n_words, passages).

    ``passages``: segments that chance would give less than ``expected`` times in such a text, with
    code points (end exclusive), score and expected number.  A null or empty text has no words and
    is scored all the same.  Repeated rows are scored alike; without usable labels every score is 0.
    A null id counts as empty text for its fold.  Other columns are ignored; no rows give no rows.
    """
    rows = texts_of(docs, id_col, text_col)
    model = train(rows, labels, folds=folds, held_fold=held_fold, **fit)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(f"score double, predicted int, n_words int, passages {PASSAGES}")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = held.value
        for batch in batches:
            texts, out = batch.tolist(), []
            for some in slices(texts, SLICE_CHARS):
                for text, (n, found) in zip(texts[some], scan(texts[some], m), strict=True):
                    if m.weights is None:
                        score = m.prior
                    else:
                        x = features(np.array([s for _, _, s in found]), n, m)
                        score = 1 / (1 + np.exp(-np.clip(np.dot(m.weights, [*x, 1.0]), -30, 30)))
                    chance = [(b, e, s, m.k * n * np.exp(-m.lam * s)) for b, e, s in found]
                    chance = [x for x in chance if x[3] < expected]
                    if chance:
                        spans = [w.span() for w in LETTERS.finditer(text)]
                        chance = [(spans[b][0], spans[e - 1][1], s, float(v)) for b, e, s, v in chance]
                    out.append((float(score), int(score >= threshold), n, chance))
            yield pd.DataFrame(out, columns=["score", "predicted", "n_words", "passages"])

    fold = bucket_of(F.col("id"), folds) == held_fold
    return rows.select("id", fold.alias("held_out"), run("text").alias("r")).select("id", "held_out", "r.*")

"""Quality rules: counts of each text, then a hashed n-gram likelihood ratio, all in Spark functions.

Words and word pairs are hashed to buckets.  The raw multinomial counts the buckets of every text,
the target multinomial those of trusted texts.  A text's score is the mean, over its n-grams, of
log(target / raw); it is kept where the base rules pass and the score reaches a fixed threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import WORD, texts_of
from leafmill.scratch import settle

BUCKETS = 1 << 18
TRUSTED_ROWS = 20_000
THRESHOLD = -0.07
SMOOTHING = 30.0
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def word_hashes(text: Column) -> Column:
    """A 64-bit hash of each word, in order."""
    bare = F.btrim(text, F.lit("\x20\t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(F.split(bare, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w))
    )


def ngram_buckets(words: Column, buckets: int) -> Column:
    """Bucket of each word, then of each pair of neighbours."""
    ones = F.transform(words, lambda w: F.pmod(w, F.lit(buckets)))
    twos = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.pmod(F.xxhash64(w, F.get(words, i + 1)), F.lit(buckets)),
    )
    return F.concat(ones, twos)


def repeated_words(windows: Column) -> Column:
    """Words covered by 3-word windows whose hash occurs twice or more."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # ``pairs`` is bound once by the outer transform, not evaluated again for each element
    found = F.get(
        F.transform(
            F.array(pairs),
            lambda s: F.array_sort(
                F.transform(
                    F.filter(
                        s,
                        lambda e, k: (F.get(s, k - 1)["h"] == e["h"])
                        | (F.get(s, k + 1)["h"] == e["h"]),
                    ),
                    lambda e: e["i"],
                )
            ),
        ),
        F.lit(0),
    )
    covered = F.aggregate(
        found,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")
        ),
        lambda a: a["n"],
    )
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
        covered
    )


def base_rules(rows: DataFrame) -> DataFrame:
    """(rid, id, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    words = F.col("words")
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    counted = rows.select("rid", "id", "text", word_hashes(F.col("text")).alias("words")).select(
        "rid",
        "id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        windows.alias("windows"),
    )
    return counted.select(
        "rid",
        "id",
        "words",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("windows")).alias("n_repeat_words"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    )


def trusted_ids(
    labels: DataFrame, *, id_col: str = "doc_id", quality_col: str = "quality", rows: int = TRUSTED_ROWS
) -> DataFrame:
    """At most ``rows`` ids that every label calls good, chosen by hash: a bounded training sample."""
    good = labels.groupBy(F.col(id_col).alias("id")).agg(F.min(quality_col).alias("q"))
    return good.where("q = 1 and id is not null").orderBy(F.xxhash64("id"), "id").limit(rows).select("id")


def bucket_ratios(
    rows: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING
) -> DataFrame:
    """(bucket, ratio) for every bucket: log(target / raw); all zero without trusted texts."""
    spark = rows.sparkSession
    marked = rows.join(F.broadcast(trusted.select("id", F.lit(1).alias("t"))), "id", "left")
    grams = marked.select("t", word_hashes(F.col("text")).alias("words")).select(
        "t", F.explode(ngram_buckets(F.col("words"), buckets)).alias("bucket")
    )
    counts = settle(
        grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("t").alias("target")),
        "buckets",
    )
    n_raw, n_target = counts.agg(F.sum("raw"), F.sum("target")).first()
    every = spark.range(buckets).select(F.col("id").alias("bucket"))
    if not n_target:
        return every.select("bucket", F.lit(0.0).alias("ratio"))
    held = every.join(counts, "bucket", "left").na.fill(0, ["raw", "target"])
    # The same share of pseudo-counts goes to both multinomials, so that what either has hardly
    # seen says nothing: log of (target + s) / N_target over (raw + s N_raw / N_target) / N_raw.
    expected = F.col("raw") * (n_target / n_raw)
    return held.select(
        "bucket", F.log((F.col("target") + smoothing) / (expected + smoothing)).alias("ratio")
    )


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
    trusted_rows: int = TRUSTED_ROWS,
    rid_col: str | None = None,
) -> DataFrame:
    """One row per text: (rid, id, the counts, base_failed, llr, kept).

    A null or empty text has no words and fails the base rules.  Without trusted texts every score
    is 0 and the base rules decide.  An empty table gives no rows.  Repeated rows are judged alike,
    and other columns are ignored.  Windows are compared by a 64-bit hash of their words' hashes.  The broadcast tables
    have ``buckets`` and at most ``trusted_rows`` rows, whatever the input.  ``rid_col`` names a
    column that numbers the rows, if there is one.
    """
    rows = texts_of(docs, id_col, text_col, rid_col)
    ratios = bucket_ratios(rows, trusted_ids(labels, rows=trusted_rows), buckets)
    # All of a text's n-grams follow each other in one task, so its sum is nearly done there.
    grams = base_rules(rows).select(
        "rid", "id", *COUNTS, F.explode_outer(ngram_buckets(F.col("words"), buckets)).alias("bucket")
    )
    scored = (
        grams.join(F.broadcast(ratios), "bucket", "left")
        .groupBy("rid")
        .agg(
            *[F.first(c).alias(c) for c in ("id", *COUNTS)],
            F.coalesce(F.avg("ratio"), F.lit(0.0)).alias("llr"),
        )
    )
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))

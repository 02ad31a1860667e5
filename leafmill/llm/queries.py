"""The operators bound to the tables, with production parameters; SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import bpe
from leafmill.llm import exact_dedup as exact
from leafmill.llm import filter_audit as audit
from leafmill.llm import line_dedup as line
from leafmill.llm import lm_scoring as lm
from leafmill.llm import near_dedup as near
from leafmill.llm import packing
from leafmill.llm import quality_rules as quality
from leafmill.llm import secret_scan as secret
from leafmill.llm import simhash
from leafmill.llm import toxicity as tox
from leafmill.llm import vector_codes as codes
from leafmill.llm import warc
from leafmill.llm.common import shipped
from leafmill.scratch import scratch


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return tox.toxicity(docs, labels).select(
        F.col("id").alias("doc_id"), "held_out", "score", "predicted", "passages"
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packing.pack(docs, tokenizer()).withColumnRenamed("id", "doc_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.quality_rules(docs, labels).drop("rid").withColumnRenamed("id", "doc_id")


def tokenizer() -> str:
    """The tokenizer file that the contracts name; any path of such a file will do."""
    return public_tokenizers.path("word_bpe_49k.json")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = secret.secrets(docs)
    base = F.filter("spans", lambda x: x["kind"] != "crf")
    told = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )
    return found.select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex",
        F.sha2(told(base).cast("binary"), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near.near_dedup(docs).drop("rid").withColumnRenamed("id", "doc_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return line.line_dedup(docs).drop("rid").withColumnRenamed("id", "doc_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return bpe.encode(docs, tokenizer(), full=False).withColumnRenamed("id", "doc_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    manifest = warc.write_warc(pages, scratch(spark, "warc"))
    return warc.read_warc(spark, manifest, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return lm.lm_scores(docs).drop("rid").withColumnRenamed("id", "doc_id")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact.exact_dedup(docs).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256"
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return coded.withColumnRenamed("id", "vec_id").withColumn(
        "codebooks_sha256", F.lit(codes.books_sha256(books))
    )


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash.simhash_dedup(docs).withColumnRenamed("id", "doc_id")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return audit.filter_audit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_quality_rules": op3_quality_rules,
    "op4_secrets": op4_secrets,
    "op5_near_dedup": op5_near_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_bpe": op7_bpe,
    "op8_warc": op8_warc,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_simhash": op12_simhash,
    "op13_filter_audit": op13_filter_audit,
}
QUERIES = {name: shipped(query) for name, query in QUERIES.items()}



def codes_sql() -> str:
    """The rounds of op11 one after the other, each over the codebooks of the one before."""
    rounds = []
    for k in range(codes.ROUNDS + 1):
        rounds.append(f"""
        a{k} AS MATERIALIZED (
            SELECT p.rn, p.part, min(list_sum(list_transform(list_zip(p.sub, c.sub),
                lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT * {codes.ENTRIES} + c.entry) AS best
            FROM p JOIN c{k} c USING (part) GROUP BY ALL
        )""")
        if k < codes.ROUNDS:
            rounds.append(f"""
        s{k} AS (
            SELECT part, best % {codes.ENTRIES} AS entry, unnest(sub) AS x, unnest(range(len(sub))) AS place
            FROM a{k} JOIN p USING (rn, part)
        ), t{k} AS (
            SELECT part, entry, place, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM s{k} GROUP BY ALL
        ), m{k} AS (
            SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) AS sub
            FROM t{k} GROUP BY ALL
        ), c{k + 1} AS MATERIALIZED (
            SELECT part, entry, coalesce(m.sub, c.sub) AS sub FROM c{k} c LEFT JOIN m{k} m USING (part, entry)
        )""")
    return f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS rn, vec_id, label,
                list_transform(embedding, lambda x: floor({codes.SCALE} * x)::BIGINT) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), p AS MATERIALIZED (
            SELECT rn, part, q[part * len(q) // {codes.PARTS} + 1 : (part + 1) * len(q) // {codes.PARTS}] AS sub
            FROM v, range({codes.PARTS}) r(part)
        ), c0 AS MATERIALIZED (
            SELECT part, rn - 1 AS entry, sub FROM p WHERE rn <= {codes.ENTRIES}
        ), {",".join(rounds)},
        e AS (
            SELECT rn, list(best % {codes.ENTRIES} ORDER BY part) AS entries,
                sum(best // {codes.ENTRIES})::BIGINT AS error
            FROM a{codes.ROUNDS} GROUP BY rn
        ), b AS (
            SELECT sha256(string_agg(array_to_string(sub, ','), ',' ORDER BY part, entry)) AS sha
            FROM c{codes.ROUNDS}
        )
        SELECT vec_id,
            array_to_string(list_transform(entries, lambda x: format('{{:02x}}', x::INT)), '') AS code,
            error,
            (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            (SELECT sha FROM b) AS codebooks_sha256
        FROM e JOIN v USING (rn)
    """


ORACLE: dict[str, str] = {
    "op11_vector_codes": codes_sql(),
    "op13_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
        ), w AS (
            SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
                min(doc_id) OVER (PARTITION BY t) AS least
            FROM d
        ), m AS (
            SELECT doc_id, part, (len(ws) < 50)::INT + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::INT
                + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t))::INT
                + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (doc_id > least)::INT AS mask
            FROM w
        ), l AS (
            SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
        ), c AS MATERIALIZED (
            SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
            FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL
        ), f AS (
            SELECT chr(65 + i::INT) AS x FROM range(5) r(i)
        ), o AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), s AS (
            SELECT filter_order, k::INT AS step, 1 << (ascii(filter_order[k::INT]) - 65) AS own,
                coalesce(list_sum(list_transform(range(1, k), lambda i: 1 << (ascii(filter_order[i::INT]) - 65))), 0)::INT
                    AS earlier
            FROM o, range(1, 6) r(k)
        ), r AS (
            SELECT part, filter_order, step, own,
                sum(n) FILTER (mask & (earlier | own) = 0) AS kept,
                sum(n) FILTER (mask & earlier = 0 AND mask & own != 0) AS removed,
                sum(n) FILTER (mask & earlier != 0 AND mask & own != 0) AS redundant,
                sum(n) FILTER (mask = own) AS unique_fails,
                sum(good) FILTER (mask & earlier = 0 AND mask & own != 0) AS good_lost,
                sum(toxic) FILTER (mask & earlier = 0 AND mask & own != 0) AS toxic_lost
            FROM c, s GROUP BY ALL
        )
        SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
            coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
            coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
            (sum(coalesce(removed, 0)) OVER (PARTITION BY part, own))::BIGINT AS shapley
        FROM r
    """,
    "op8_warc": r"""
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), h AS (
            SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS sha FROM p
        ), c AS (
            SELECT *, max(page_id) OVER (PARTITION BY sha) AS last,
                row_number() OVER (PARTITION BY sha ORDER BY page_id DESC) = 1 AS first
            FROM h
        )
        SELECT page_id, payload_bytes,
            array_to_string(list_transform(range(32), lambda i: substr(
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(sha, 1 + (i // 4)::INT * 5, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31),
                1)), '') AS payload_digest,
            CASE WHEN first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN NOT first THEN last END AS refers_to
        FROM c
    """,
    "op10_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text FROM documents
        ), h AS (
            SELECT doc_id, length(text) AS n,
                sha256(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS sha
            FROM t
        )
        SELECT doc_id,
            first_value(doc_id) OVER w AS keep_id,
            count(*) OVER (PARTITION BY sha) AS group_size,
            row_number() OVER w = 1 AS kept,
            sha AS text_sha256
        FROM h
        WINDOW w AS (PARTITION BY sha ORDER BY n DESC, doc_id)
    """,
}

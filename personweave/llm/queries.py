"""Registered queries of the operators, with production parameters, and their DuckDB twins where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personweave.llm import (bpe, exact_dedup, extract, fill_middle, licenses, packing, pii, quality, simhash_dedup, topk, toxicity,
                             vector_codes, warc)
from personweave.llm.session import small_batches
from personweave.sources.scratch import scratch_root

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
END_ID = 2
# A key that is public is no secret: real runs pass their own.
KEY = b"personweave demonstration key"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_read(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    return warc.archive_pages(_read(spark, sf_dir, "pages"), path)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(_read(spark, sf_dir, "pages"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(_read(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), CAPACITY, END_ID)


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(_read(spark, sf_dir, "documents"), KEY)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(_read(spark, sf_dir, "embeddings"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(_read(spark, sf_dir, "documents")))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_license_scan, op2_exact_dedup, op3_quality, op4_warc, op5_main_text, op6_top_k, op7_simhash,
                            op8_packing, op9_pseudonyms, op10_bpe, op11_vector_codes, op12_fill_middle, op13_toxicity, pipeline)}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal FROM documents),
             g AS (SELECT normal, arg_min(doc_id, (-n_chars, doc_id)) AS keep_id, count(*) AS group_size FROM d GROUP BY normal)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(normal) AS text_sha256
        FROM d JOIN g USING (normal)""",
    "op4_warc": r"""
        WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
             b AS (SELECT page_id, payload_bytes,
                          array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
                              (((('0x' || substr(h, (i // 4)::BIGINT * 5 + 1, 5))::BIGINT) >> (5 * (3 - i % 4))::BIGINT) & 31), 1)), '')
                          AS payload_digest FROM p),
             f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM b)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM f""",
    "op6_top_k": r"""
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS w FROM embeddings
                   WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
                   FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
             r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
                   FROM s)
        SELECT * FROM r WHERE rank <= 10""",
    "op11_vector_codes": r"""
        WITH v AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w
                   FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             i AS MATERIALIZED (SELECT r, vec_id, part, w[part * len(w) // 16 + 1:(part + 1) * len(w) // 16] AS w FROM v, range(16) AS t(part)),
             f AS (SELECT r, row_number() OVER (ORDER BY vec_id, w) - 1 AS entry FROM v WHERE vec_id IS NOT NULL),
             c0 AS (SELECT part, entry, w FROM i JOIN f USING (r) WHERE entry < 64),
             d0 AS (SELECT i.r, i.part, c.entry, list_sum(list_transform(list_zip(i.w, c.w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist
                    FROM i JOIN c0 c USING (part)),
             a0 AS (SELECT r, part, min(dist) AS dist, arg_min(entry, (dist, entry)) AS entry FROM d0 GROUP BY r, part),
             u0 AS (SELECT part, entry, list(floor(total / n)::BIGINT ORDER BY k) AS w
                    FROM (SELECT part, entry, k, sum(i.w[k]) AS total, count(*) AS n
                          FROM a0 JOIN i USING (r, part), range(1, (SELECT max(len(w)) FROM i) + 1) AS t(k) GROUP BY part, entry, k)
                    GROUP BY part, entry),
             c1 AS (SELECT part, entry, coalesce(u.w, c.w) AS w FROM c0 c LEFT JOIN u0 u USING (part, entry)),
             d1 AS (SELECT i.r, i.part, c.entry, list_sum(list_transform(list_zip(i.w, c.w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist
                    FROM i JOIN c1 c USING (part)),
             a1 AS (SELECT r, part, min(dist) AS dist, arg_min(entry, (dist, entry)) AS entry FROM d1 GROUP BY r, part),
             u1 AS (SELECT part, entry, list(floor(total / n)::BIGINT ORDER BY k) AS w
                    FROM (SELECT part, entry, k, sum(i.w[k]) AS total, count(*) AS n
                          FROM a1 JOIN i USING (r, part), range(1, (SELECT max(len(w)) FROM i) + 1) AS t(k) GROUP BY part, entry, k)
                    GROUP BY part, entry),
             c2 AS (SELECT part, entry, coalesce(u.w, c.w) AS w FROM c1 c LEFT JOIN u1 u USING (part, entry)),
             d2 AS (SELECT i.r, i.part, c.entry, list_sum(list_transform(list_zip(i.w, c.w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist
                    FROM i JOIN c2 c USING (part)),
             a2 AS (SELECT r, part, min(dist) AS dist, arg_min(entry, (dist, entry)) AS entry FROM d2 GROUP BY r, part),
             o AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM a2 GROUP BY r),
             s AS (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM o JOIN v USING (r), s""",
    "op12_fill_middle": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                          sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
             h AS (SELECT doc_id, t, n, ('0x' || substr(s, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(s, 9, 8))::BIGINT % (n + 1) AS b,
                          ('0x' || substr(s, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(s, 25, 8))::BIGINT % 100 AS h4 FROM d),
             f AS (SELECT doc_id, t, n, least(a, b) AS i, greatest(a, b) AS j,
                          CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
                               WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
             p AS (SELECT *, substr(t, 1, i) AS prefix, substr(t, i + 1, j - i) AS middle, substr(t, j + 1) AS suffix FROM f)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars, CASE WHEN form <> 'plain' THEN j - i END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM p""",
}

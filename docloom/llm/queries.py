"""Registered queries of the subpackage, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, licenses, lm_score, mixing, multi_index, omh, packing, toxicity, vafile, warc


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omh.near_duplicates(_read(spark, sf_dir, "documents"))


def op2_va_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents"))


def op7_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op9_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_read(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_order_minhash, op2_va_top_k, op3_lexical_packing, op4_multi_index, op5_toxicity,
            op6_license_scan, op7_cross_entropy, op8_language_mixture, op9_sainte_lague, op10_warc,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_va_top_k": """
            WITH v AS (
              SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
              WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(embedding) > 0),
            s AS (
              SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
            r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
            SELECT query_id, k::INTEGER AS rank, vec_id, score FROM r WHERE k <= 20
        """,
        "op4_multi_index": """
            WITH RECURSIVE v AS (
              SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
            l AS (
              SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
              WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
            walk AS (
              SELECT vec_id AS id, vec_id AS reach FROM v
              UNION SELECT w.id, l.v FROM walk w JOIN l ON w.reach = l.u),
            parts AS (SELECT id, min(reach) AS component_id FROM walk GROUP BY id),
            n AS (SELECT u, count(*) AS n_links FROM l GROUP BY u)
            SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, p.component_id, v.vec_id = p.component_id AS kept
            FROM v JOIN parts p ON p.id = v.vec_id LEFT JOIN n ON n.u = v.vec_id
        """,
        "op10_warc": """
            WITH p AS (
              SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
            g AS (SELECT payload_digest, max(page_id) AS response FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
            SELECT p.page_id, p.payload_bytes, p.payload_digest,
              CASE WHEN g.response <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
              CASE WHEN g.response <> p.page_id THEN g.response END AS refers_to
            FROM p LEFT JOIN g ON g.payload_digest = p.payload_digest AND p.payload_bytes >= 1000
        """,
    }

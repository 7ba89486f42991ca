"""Registered queries of the package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.llm import (decontaminate, html_extract, jaccard_join, langid, mixing, negatives, packing, repeats, ring,
                            topk, toxicity, warc, word_runs)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# shares of tokens in the mixture, by label class
MIXTURE = {"high": 0.85, "low": 0.10, "toxic": 0.05}


def label_class():
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")


def op1_mixing_rates(spark, sf_dir):
    """Rates of all documents that bring the label classes to their target shares."""
    return mixing.mix(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"), label_class(), MIXTURE)


def op2_benchmark_templates(spark, sf_dir):
    """Documents that contain a benchmark item, word for word or with other slot values."""
    return decontaminate.contaminated(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"))


def op3_warc_transactions(spark, sf_dir):
    """All pages to WARC records and back, one row per assembled capture."""
    return warc.round_trip(_t(spark, sf_dir, "pages"))


def op4_language_id(spark, sf_dir):
    """Language of every document; the fold with remainder 2 of 4 is held out."""
    return langid.identify(_t(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    """Toxicity of every document; the fold with remainder 0 of 5 is held out."""
    return toxicity.classify(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"))


def op6_repeated_passages(spark, sf_dir):
    """All documents without bytes that 400-byte repeats cover."""
    return repeats.remove_repeats(_t(spark, sf_dir, "documents"))


def op7_jaccard_components(spark, sf_dir):
    """Shingle sets of all documents and the components of their similarity links."""
    return jaccard_join.link_components(_t(spark, sf_dir, "documents"))


def op8_exact_top_k(spark, sf_dir):
    """The 20 best other vectors of every row whose id is divisible by 20."""
    return topk.exact_top_k(_t(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return html_extract.extract(_t(spark, sf_dir, "pages"))


def op10_ring_sharding(spark, sf_dir):
    """All documents to shards 0 to 23 on a ring with bounded loads."""
    return ring.shard_documents(_t(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(_t(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every row whose id is divisible by 100; labels of ids divisible by 7 are shifted."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_t(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 100 == 0)


def op13_periodic_runs(spark, sf_dir):
    """Periodic runs of words in every document; a tenth of them get a repeated tail first."""
    return word_runs.periodic_runs(_t(spark, sf_dir, "documents"), word_runs.repeated_tail)


QUERIES = {
    "op1_mixing_rates": op1_mixing_rates,
    "op2_benchmark_templates": op2_benchmark_templates,
    "op3_warc_transactions": op3_warc_transactions,
    "op4_language_id": op4_language_id,
    "op5_toxicity": op5_toxicity,
    "op6_repeated_passages": op6_repeated_passages,
    "op7_jaccard_components": op7_jaccard_components,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_html_extraction": op9_html_extraction,
    "op10_ring_sharding": op10_ring_sharding,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL = {
    "op3_warc_transactions": """
        WITH p AS (
          SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
                 sha1(encode(coalesce(html, ''))) AS payload_digest FROM pages),
        n AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top,
                     row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST, url) AS nth
              FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND nth > 1 THEN top END AS refers_to
        FROM n""",
    "op8_exact_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS vec
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
        u AS (SELECT vec_id, min(vec) AS vec FROM v GROUP BY vec_id),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id,
                 CASE WHEN len(q.vec) = 0 THEN 0
                      ELSE list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) END AS score
          FROM u q JOIN u c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec)
          WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM s)
        SELECT query_id, rk::INTEGER AS rank, vec_id, score::BIGINT AS score FROM r WHERE rk <= 20""",
    "op12_hard_negatives": """
        WITH v AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec
          FROM embeddings
          WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
        u AS (SELECT vec_id, min({'label': label, 'vec': vec}) AS r FROM v GROUP BY vec_id),
        t AS (SELECT vec_id, r.label AS label, r.vec AS vec FROM u),
        s AS (
          SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                 CASE WHEN len(a.vec) = 0 THEN 0
                      ELSE list_sum(list_transform(list_zip(a.vec, c.vec), lambda p: p[1] * p[2])) END::BIGINT AS score
          FROM t a JOIN t c ON a.vec_id <> c.vec_id AND len(a.vec) = len(c.vec)
          WHERE a.vec_id % 100 = 0),
        p AS (SELECT * FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (
          SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
                 s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rk
          FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
               AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
        SELECT anchor_id, positive_id, rk::INTEGER AS rank, negative_id, positive_score, negative_score
        FROM n WHERE rk <= 5""",
}

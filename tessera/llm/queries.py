"""Registered queries of the operators: ``QUERIES`` and ``ORACLE`` by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (
    embed_dups, packing, pieces, pii, quality, rendezvous, repeats, resample, simhash, token_store, topk,
    url_rules, va_clusters,
)
from tessera.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_and_read(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dups.linked(table(spark, sf_dir, "embeddings"))


def op3_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendezvous.documents_by_key(table(spark, sf_dir, "documents"), 16)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.documents(table(spark, sf_dir, "documents"))


def op6_no_random_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.linked(table(spark, sf_dir, "documents"))


#: The contract's rules: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judged(table(spark, sf_dir, "pages"), rules)


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"))


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removals(table(spark, sf_dir, "documents"))


def op11_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detected(table(spark, sf_dir, "documents"))


def op12_va_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_clusters.clustered(table(spark, sf_dir, "embeddings"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_token_store, op2_hnsw, op3_rendezvous_shards, op4_quality, op5_best_fit, op6_no_random_access, op7_simhash,
    op8_url_rules, op9_pieces, op10_suffix_array, op11_weak_labels,
    op12_va_clusters, op13_resample)}


def _fits(host: str, path: str) -> str:
    return f"((host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}'))"


#: Longer hosts first, then longer paths: the order in which a rule wins.
_BY_LENGTH = sorted(URL_RULES, key=lambda r: (-r[0].count("."), -len(r[1])))

ORACLE: dict[str, str] = {
    "op12_va_clusters": va_clusters.sql(),
    "op6_no_random_access": f"""
  WITH good AS (
    SELECT vec_id, [floor({topk.SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
  scores AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM good q JOIN good c ON q.vec_id % {topk.EVERY} = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
  SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
  WHERE rank <= {topk.K}""",
    "op8_url_rules": f"""
  WITH rest AS (
    SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') = 0 THEN ''
                         ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
  split AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
  ruled AS (
    SELECT page_id, host, path,
           CASE {" ".join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for h, p, _ in _BY_LENGTH)} END AS rule FROM split)
  SELECT page_id, host, path, rule,
         CASE {" ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in URL_RULES)}
              ELSE '{url_rules.DEFAULT}' END AS verdict
  FROM ruled""",
}

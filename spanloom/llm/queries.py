"""The contract's queries over the driver's tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, language_id, license_scan, lm_score, mixing, ngram_join, sharding, substring_dedup, url_filter

#: Fixed values of the contract: (host, path, verdict).
URL_RULES = (
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
)
#: The policy for URLs without a rule: block these, allow the rest.
URL_GLOBS = ("*cheap-pills.*", "*spam-farm.*")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_digest(_read(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_read(spark, sf_dir, "documents")).drop("kept_text")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(_read(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(_read(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_read(spark, sf_dir, "pages"), URL_RULES, URL_GLOBS)


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(_read(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_read(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_classes(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS r FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), judged AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow'
  WHEN contains(host || path, 'cheap-pills.') OR contains(host || path, 'spam-farm.') THEN 'block'
  ELSE 'allow' END AS verdict FROM judged
"""

OP10_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), w AS (
  SELECT doc_id, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size, sha256(norm) AS text_sha256 FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_sharding": op3_sharding,
    "op4_decontaminate": op4_decontaminate,
    "op5_mixing": op5_mixing,
    "op6_url_filter": op6_url_filter,
    "op7_lm_score": op7_lm_score,
    "op8_license_scan": op8_license_scan,
    "op9_ngram_join": op9_ngram_join,
    "op10_exact_dedup": op10_exact_dedup,
}

SQL: dict[str, str] = {"op6_url_filter": OP6_SQL, "op10_exact_dedup": OP10_SQL}

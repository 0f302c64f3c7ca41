"""The text-preparation queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import table
from . import embeddings, lm, token_files, whitening
from .interaction import audit
from .language import identify
from .minhash import near_duplicates
from .packing import pack
from .quality import judge_quality
from .pii import pseudonymise
from .secrets import scan
from .sentencepiece_bpe import digest
from .urls import filter_urls

#: The registered query's key; a user passes a key of their own.
PSEUDONYM_KEY = b"an example key"


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; the operators take such a path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(table(spark, sf_dir, "embeddings"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digest(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_url_filters": op2_url_filters,
    "op3_language_id": op3_language_id,
    "op4_quality_rules": op4_quality_rules,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_secret_scans": op6_secret_scans,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_pii": op9_pii,
    "op10_packing": op10_packing,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_token_files": op12_token_files,
    "op13_filter_interaction_audit": op13_filter_interaction_audit,
}

_URLS = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest
), urls AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM parts
), rules(action, rule, rule_host, rule_path) AS (
  VALUES ('block', 'com/en/', 'com', '/en/'), ('allow', 'example.com/en/7', 'example.com', '/en/7'), ('allow', 'net/de/', 'net', '/de/'),
         ('block', 'example.net/de/8', 'example.net', '/de/8'), ('block', 'org/es/', 'org', '/es/')
), judged AS (
  SELECT u.page_id, u.host, u.path,
         (SELECT arg_max(struct_pack(rule := x.rule, action := x.action), length(x.rule)) FROM rules x
          WHERE (u.host = x.rule_host OR ends_with(u.host, '.' || x.rule_host)) AND starts_with(u.path, x.rule_path)) AS best,
         translate(u.host || u.path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS seen
  FROM urls u
)
SELECT page_id, host, path, best.rule AS rule,
       CASE WHEN best IS NOT NULL THEN best.action
            WHEN regexp_matches(seen, '(^|[^a-z0-9])(casino-museum|poker-history)($|[^a-z0-9])') THEN 'allow'
            WHEN regexp_matches(seen, '(^|[^a-z0-9])(casino|poker|viagra|free-pills|porn|xxx)($|[^a-z0-9])')
              OR regexp_matches(seen, '(^|[^a-z0-9])adserver.*/click') OR strpos(seen, '/phpmyadmin/') > 0
              OR regexp_matches(seen, '/wp-login\.php($|[^a-z0-9])') THEN 'block'
            ELSE 'allow' END AS verdict
FROM judged
"""

_AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM texts
), judged AS (
  SELECT doc_id, part, map {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w), 'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
         'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc_id > first_id, false)} AS fails FROM words
), marked AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id
), docs AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM judged LEFT JOIN marked USING (doc_id) GROUP BY part, fails
), letters(x) AS (
  VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT o, step, substr(o, step, 1) AS f, substr(o, 1, step - 1) AS gone FROM orders, (SELECT unnest(range(1, 6)) AS step)
), applied AS (
  SELECT part, o, step, f, n, n_good, n_toxic, fails[f] AS hit, len(list_filter(string_split(gone, ''), lambda y: y <> '' AND fails[y])) > 0 AS before,
         len(list_filter(map_values(fails), lambda y: y)) = 1 AS alone
  FROM docs, steps
), counted AS (
  SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, f, CAST(coalesce(sum(n) FILTER (NOT hit AND NOT before), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (hit AND NOT before), 0) AS BIGINT) AS removed, CAST(coalesce(sum(n) FILTER (hit AND before), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (hit AND alone), 0) AS BIGINT) AS unique_fails, CAST(coalesce(sum(n_good) FILTER (hit AND NOT before), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(n_toxic) FILTER (hit AND NOT before), 0) AS BIGINT) AS toxic_lost
  FROM applied GROUP BY part, o, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
ORACLE_SQL: dict[str, str] = {"op2_url_filters": _URLS.strip(), "op13_filter_interaction_audit": _AUDIT.strip()}

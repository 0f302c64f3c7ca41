"""Queries of tagging with kept answers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import answers
from ..session import checkpoint_dir, remove, table
from .registry import query

MODEL, ENDPOINT, NOW = "by length", "https://tags.example", "2024-01-01"


def by_length(text: str) -> str:
    """Stands for a model: tags by the text's length; every eleventh length fails."""
    if len(text) % 11 == 0:
        raise ValueError("refused")
    return '```json\n["%s", "other", "리스"]\n```' % ("손상" if len(text) % 2 else "수익인식")


@query(
    """
    WITH f AS (SELECT doc_id AS pos, CASE WHEN doc_id % 17 = 0 THEN '' ELSE CAST(doc_id % 700 AS VARCHAR) END AS rcept_no, text FROM documents WHERE trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''),
    k AS (SELECT rcept_no, arg_min(text, pos) AS text FROM f WHERE rcept_no <> '' GROUP BY rcept_no)
    SELECT rcept_no, CASE WHEN length(text) % 11 = 0 THEN '-' WHEN length(text) % 2 = 1 THEN '손상,리스' ELSE '수익인식,리스' END AS tags, CASE WHEN length(text) % 11 = 0 THEN '-' ELSE 'other' END AS dropped,
           sha256('by length' || chr(10) || 'https://tags.example' || chr(10) || text) AS kam_hash, CASE WHEN length(text) % 11 = 0 THEN 'ValueError' ELSE '-' END AS error, 'by length' AS model, 'https://tags.example' AS base_url, '2024-01-01' AS tagged_at FROM k
    UNION ALL SELECT '__norcept_' || (pos + 1), '-', '-', '-', 'missing_rcept_no', 'by length', 'https://tags.example', '2024-01-01' FROM f WHERE rcept_no = ''
    """
)
def tags_kept(spark, sf_dir):
    """All documents as facts, several with one receipt number; the vocabulary's order rules the tags'."""
    facts = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pos"), F.when(F.col("doc_id") % 17 == 0, "").otherwise((F.col("doc_id") % 700).cast("string")).alias("rcept_no"), F.lit(True).alias("kam_present"), F.col("text").alias("kam_raw"))
    folder = f"{checkpoint_dir(spark)}/answers-{uuid.uuid4().hex}"
    try:
        sidecar = answers.tag_kept(facts, by_length, MODEL, NOW, folder, base_url=ENDPOINT, pos="pos", keep_every=1000, buckets=8)
    finally:
        remove(spark, folder)
    shown = lambda c: F.coalesce(F.array_join(c, ","), F.lit("-")).alias(c)
    said = lambda c: F.coalesce(c, F.lit("-")).alias(c)
    return sidecar.select("rcept_no", shown("tags"), shown("dropped"), said("kam_hash"), said("error"), "model", "base_url", "tagged_at")

"""Topic cases: validity with the first failing reason, topics, snippet, identifier, confidence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dictionaries as D
from ..functions import text as T
from .aggregates import completeness
from .collect import parse_pairs

MATTERS = ("special_matter", "emphasis_matter", "core_audit_matter")


def year_of(c: Column) -> Column:
    """An integer as it is commonly written: outer white space, a sign, single underscores between digits."""
    plain = T.strip(c)
    return F.when(plain.rlike(r"^[+-]?\d+(_\d+)*\z"), F.regexp_replace(plain, "_", "").try_cast("int"))


def _topics_found(text: Column, topics: Sequence[tuple[str, str]], exclusions: Mapping[str, Sequence[str]]) -> Column:
    """Structs (slug, term) of the topics that occur, in their order."""
    found = F.array(*(F.when(T.has_term(text, term, exclusions.get(term, ())), F.struct(F.lit(slug).alias("slug"), F.lit(term).alias("term"))) for slug, term in topics))
    return F.filter(found, lambda x: x.isNotNull())


def with_reason(records: DataFrame) -> DataFrame:
    """Adds ``reason``: what is missing first of receipt number, company code and year; null where nothing is."""
    reason = F.when(T.blank(F.col("rcept_no")), "missing_rcept_no").when(T.blank(F.col("corp_code")), "missing_corp_code").when(year_of(F.coalesce("bsns_year", F.lit(""))).isNull(), "invalid_fiscal_year")
    return records.withColumn("reason", reason)


def parse_topics(said: str) -> list[tuple[str, str]]:
    """``slug:term,slug:term`` as pairs; blank parts are skipped, a part without slug or term is an error."""
    return parse_pairs(said, "slug:term")


def topic_cases(
    records: DataFrame, fresh: str, topics: Sequence[tuple[str, str]] = D.TOPICS, exclusions: Mapping[str, Sequence[str]] = D.TOPIC_EXCLUSIONS, prefix: str = "case",
    url: str = "%s", extra: Sequence[tuple[str, str]] = (),
) -> tuple[DataFrame, DataFrame]:
    """(cases, rejected records with their reason). ``fresh`` is the timestamp to note, ``url`` the address of a receipt
    number; ``extra`` topics follow the others."""
    topics = [*topics, *extra]
    judged = with_reason(records)
    told = T.join_present(*(F.coalesce(F.col(c), F.lit("")) for c in ("audit_opinion", *MATTERS)))
    text = judged.filter("reason is null").withColumn("text", told).withColumn("found", _topics_found(F.col("text"), topics, exclusions))
    slug = F.coalesce(F.get("found", F.lit(0))["slug"], F.lit(D.DEFAULT_TOPIC))
    term = F.coalesce(F.get("found", F.lit(0))["term"], F.lit("\u0000"))
    year, corp, receipt = year_of(F.col("bsns_year")), T.strip(F.col("corp_code")), T.strip(F.col("rcept_no"))
    code = T.short_hash(*(F.coalesce(F.col(c), F.lit("")) for c in ("auditor", "audit_opinion", *MATTERS)))
    said = (F.col("audit_opinion") != D.UNKNOWN) & T.present(F.col("audit_opinion"))
    cases = text.select(
        F.concat_ws("-", F.lit(prefix), corp, year.cast("string"), receipt, slug, code).alias("case_id"),
        corp.alias("company_identifier"), F.col("corp_name").alias("company_name"), year.alias("fiscal_year"), receipt.alias("report_id"), "auditor",
        F.transform("found", lambda x: x["term"]).alias("topic_tags"), T.snippet(F.col("text"), term).alias("disclosure_snippet"), F.format_string(url, receipt).alias("source_url"),
        receipt.alias("document_id"), completeness(T.present(F.col("auditor")), said, T.present(F.col("core_audit_matter")), T.present(F.col("emphasis_matter"))).alias("extraction_confidence"), F.lit(fresh).alias("freshness_timestamp"),
    )
    return cases, judged.filter("reason is not null")

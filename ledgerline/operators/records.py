"""Audit records from responses, filings beside their documents, results in the order of the input."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dictionaries import REPORT_LABELS
from ..functions import text as T
from .collect import source_url
from .dedup import distinct_rows
from .facts import choose_documents
from .search import required

#: Where a wire row holds the parts of an audit record.
WIRE = {"auditor": "adtor", "audit_opinion": "adt_opinion", "special_matter": "adt_reprt_spcmnt_matter", "emphasis_matter": "emphs_matter", "core_audit_matter": "core_adt_matter", "settlement_date": "stlm_dt"}
#: Kinds of errors that are no failures.
SKIPPED = {"no_consolidated": "skipped_no_consolidated"}
FAILED, NO_DOCUMENT = "failed", "no_xml"


def audit_records(wire: DataFrame, pos: str, business_year: str, report_code: str, template: str, names: Mapping[str, str] = REPORT_LABELS) -> DataFrame:
    """Wire rows of one query as audit records with ``pos``; of rows that are equal in all fields the first stays.

    Year and code are the query's. Texts have single spaces. A missing value is an empty string.
    """
    required(bsns_year=business_year)
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in wire.columns else F.lit("")
    year, label = business_year.strip(), names.get(report_code, report_code)
    columns = {c: value(c) for c in ("corp_code", "corp_name", "corp_cls", "rcept_no")}
    columns |= {"bsns_year": F.lit(year), "reprt_code": F.lit(report_code), "business_year_label": F.lit(f"{year}년 {label}")}
    columns |= {n: T.collapse(value(c)) for n, c in WIRE.items()} | {"source_url": source_url(value("rcept_no"), template)}
    return distinct_rows(wire.select(F.col(pos).alias("pos"), *(c.alias(n) for n, c in columns.items())), list(columns), "pos")


def companies(wire: DataFrame) -> DataFrame:
    """Wire rows as company records; a missing value is an empty string."""
    names = ("corp_code", "corp_name", "stock_code", "modify_date")
    return wire.select(*(F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) if n in wire.columns else F.lit("").alias(n) for n in names))


def split_blank(filings: DataFrame, pos: str, key: str = "rcept_no") -> tuple[DataFrame, DataFrame]:
    """(filings with a stripped key, those without one). A blank key is told by its place, ``__norcept_1`` for the first.

    Places count from 0 in ``pos``.
    """
    blank = T.blank(F.col(key))
    named = F.concat(F.lit("__norcept_"), (F.col(pos) + 1).cast("string"))
    return filings.filter(~blank).withColumn(key, T.strip(F.col(key))), filings.filter(blank).withColumn(key, named).withColumn("status", F.lit("missing_rcept_no"))


def with_documents(filings: DataFrame, files: DataFrame, key: str = "rcept_no") -> DataFrame:
    """Filings with the ``path`` of their document; ``status`` is ``no_xml`` where there is none to choose, else null."""
    chosen = choose_documents(files)
    return filings.join(chosen, key, "left").withColumn("status", F.when(F.col("path").isNull(), F.lit(NO_DOCUMENT)))


def in_input_order(filings: DataFrame, results: DataFrame, pos: str, key: str = "rcept_no") -> DataFrame:
    """A result for each input row, with its place; an input that repeats repeats its result. A writer sorts by place."""
    return filings.select(pos, key).join(results, key)


def status_of(kind: Column, skipped: Mapping[str, str] = SKIPPED) -> Column:
    """A filing's status from the kind of its error: failed, but for the kinds that only skip it; null stays null."""
    pairs = [F.lit(x) for kv in skipped.items() for x in kv]
    return F.when(kind.isNotNull(), F.coalesce(F.try_element_at(F.create_map(*pairs), kind), F.lit(FAILED)))

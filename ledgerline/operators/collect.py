"""Bulk collection: windows by targets, keyword filter, classification, last-wins upsert, order, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dictionaries as D
from ..functions.dates import split_windows
from ..functions.text import first_contained
from .aggregates import counts
from .dedup import keep_last
from .search import without_markers


def tasks(spark: SparkSession, start: str, end: str, targets: Sequence[tuple[str, str]] = D.COLLECTION_TARGETS) -> DataFrame:
    """(task_pos, pblntf_ty, name_keyword, bgn_de, end_de, task_key) for every target and window, targets first."""
    listed = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(t).alias("pblntf_ty"), F.lit(k).alias("name_keyword")) for i, (t, k) in enumerate(targets))))
    found = split_windows(spark, start, end).withColumn("t", listed)
    key = F.concat_ws("|", "t.pblntf_ty", "t.name_keyword", "bgn_de", "end_de")
    return found.select((F.col("t.i") * 100_000 + F.col("pos")).alias("task_pos"), "t.pblntf_ty", "t.name_keyword", "bgn_de", "end_de", key.alias("task_key"))


def parse_pairs(said: str, form: str = "TYPE:keyword") -> list[tuple[str, str]]:
    """``a:b,c:d`` as pairs; blank parts are skipped, a part without two sides is an error."""
    out = []
    for part in (p.strip() for p in said.split(",")):
        if part:
            left, colon, right = (x.strip() for x in part.partition(":"))
            if not (left and colon and right):
                raise ValueError(f"{part!r} is not of the form {form}")
            out.append((left, right))
    return out


def parse_targets(said: str) -> list[tuple[str, str]]:
    """Collection targets of a ``TYPE:keyword`` list; the default ones for a blank text."""
    return parse_pairs(said) if said.strip() else list(D.COLLECTION_TARGETS)


def source_url(receipt: Column, template: str) -> Column:
    return F.when(receipt != "", F.format_string(template, receipt)).otherwise("")


def collect(pages: DataFrame, exclude_corrections: bool = False, categories: Sequence[str] = D.CATEGORIES) -> DataFrame:
    """Rows of scanned pages (with task_pos, page_no, row_no, name_keyword) as a collection: one row for each filing.

    The rows come in no order; ``in_order`` sorts them for a writer.
    """
    found = pages.filter(F.col("report_name").contains(F.col("name_keyword")))
    if exclude_corrections:
        found = without_markers(found, "report_name", D.CORRECTION_MARKERS)
    last = keep_last(found, ["rcept_no"], "task_pos", "page_no", "row_no")
    return last.withColumn("category", first_contained(F.col("report_name"), categories, D.OTHER_CATEGORY))


def in_order(collected: DataFrame) -> DataFrame:
    return collected.orderBy("rcept_dt", "rcept_no")


def disclosures(wire: DataFrame, template: str) -> DataFrame:
    """Wire rows as filings: other names for the report and the remark, nothing for a missing value, the filing's address."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in wire.columns else F.lit("")
    kept = [c for c in wire.columns if c in ("task_pos", "page_no", "row_no", "name_keyword")]
    named = {"report_name": "report_nm", "remark": "rm"} | {c: c for c in ("rcept_no", "rcept_dt", "corp_code", "corp_name", "stock_code", "corp_cls", "flr_nm")}
    return wire.select(*kept, *(value(c).alias(n) for n, c in named.items()), source_url(value("rcept_no"), template).alias("source_url"))


def manifest(collected: DataFrame, generated_at: str, targets: Sequence[tuple[str, str]], windows: Sequence[tuple[str, str]], failed: DataFrame) -> DataFrame:
    """One row that sums a collection up: what was asked for, totals by category, and the pages that failed.

    The records themselves are a dataset of their own (``in_order(collected)``), as they grow with the collection.
    """
    sums = counts(collected, "category").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("counts_by_category"))
    pages = failed.agg(F.array_sort(F.collect_list(F.struct("pblntf_ty", "name_keyword", "bgn_de", "end_de", "page_no", "message"))).alias("failed_pages"))
    listed = lambda pairs: F.array(*(F.array(F.lit(a), F.lit(b)) for a, b in pairs)).cast("array<array<string>>")
    asked = collected.sparkSession.range(1).select(F.lit(generated_at).alias("generated_at"), listed(targets).alias("targets"), listed(windows).alias("windows"))
    return asked.join(sums).join(pages)


def manifest_counts(collected: DataFrame) -> DataFrame:
    return counts(collected, "category")

"""A collection from its targets and days to its manifest: one call, which may be made again until nothing is missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dictionaries as D
from ..functions.dates import windows
from ..sources import ledger, single
from ..streaming.incremental import guard_parameters
from . import collect

WIRE = "rcept_no string, rcept_dt string, corp_code string, corp_name string, stock_code string, corp_cls string, flr_nm string, report_nm string, rm string"


def collected(spark: SparkSession, folder: str, tasks: DataFrame, template: str, exclude_corrections: bool = False) -> DataFrame:
    """The filings among the pages that the folder holds: one row each, of the last task and page that gave it."""
    wire = ledger.records(spark, f"{folder}/pages").withColumn("x", F.from_json("record", WIRE)).select("task", "page_no", "row_no", "x.*")
    own = wire.join(tasks.select(F.col("task_key").alias("task"), "task_pos", "name_keyword"), "task")
    return collect.collect(collect.disclosures(own, template), exclude_corrections)


def failed_pages(spark: SparkSession, folder: str, tasks: DataFrame) -> DataFrame:
    """(task_key, pblntf_ty, name_keyword, bgn_de, end_de, page_no, message) of the pages that no run has got yet."""
    bad = ledger.ledger(spark, f"{folder}/pages").filter(~F.col("status").isin(ledger.OK, ledger.NO_ROWS))
    return tasks.join(bad.select(F.col("task").alias("task_key"), "page_no", "message"), "task_key").drop("task_pos")


def run(
    spark: SparkSession, fetch: str, start: str, end: str, folder: str, generated_at: str, template: str, targets: Sequence[tuple[str, str]] = D.COLLECTION_TARGETS,
    exclude_corrections: bool = False, attempts: int = 4, pace: float = 0.15, at_once: int = 1000, quota: int | None = None,
) -> DataFrame:
    """Fetches what the folder lacks, writes ``manifest.json`` in it, and returns the filings.

    ``fetch`` (``module:function``) takes a task's key, ``type|keyword|first day|last day``, and a page. Another run in the
    folder must ask for the same targets and days. A page that failed is told in the manifest and tried again by the next
    run. The manifest holds the rows in order of day and number, and their counts by category.
    """
    guard_parameters(spark, f"{folder}/parameters", {"bgn_de": start, "end_de": end, "targets": [list(t) for t in targets]})
    tasks = collect.tasks(spark, start, end, targets)
    keys = [r.task_key for r in tasks.orderBy("task_pos").select("task_key").collect()]  # targets times windows
    ledger.collect_pages(spark, fetch, keys, f"{folder}/pages", attempts, pace, at_once, quota=quota)
    found = collected(spark, folder, tasks, template, exclude_corrections)
    failed = [r.asDict() for r in failed_pages(spark, folder, tasks).orderBy("task_key", "page_no").collect()]
    about = {"generated_at": generated_at, "targets": [list(t) for t in targets], "windows": windows(start, end), "failed_pages": failed}
    single.write_manifest(found, f"{folder}/manifest.json", "rcept_dt", "rcept_no", about=about, counted="category")
    return found

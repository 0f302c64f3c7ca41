"""Pages collected in committed batches: what was fetched once is never fetched again, and all tasks keep one pace.

A batch of pages is one Spark job that writes one folder below ``folder``; Spark's committer shows it whole or not at all.
Every page leaves a row about itself (``row_no`` null: status, pages in all, calls made) beside the rows of its records, so
the pages are their own ledger: a run that is begun again, after a crash or with more tasks, asks for what is missing only.

Calls are dealt to ``slots`` partitions in turn. The i-th of n sends at i, i + n, ... steps of the pace, and never sooner
than n steps after its last call; retries take slots of their own. So all partitions together never exceed the pace.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import listed
from .paged import NO_ROWS, OK, page_rows

SCHEMA = "task string, page_no int, row_no int, record string, status string, message string, total_page int, calls int"


class Pace:
    """The times of one partition's calls."""

    def __init__(self, place: int, slots: int, step: float, start: float, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.step, self.next, self._clock, self._sleep = slots * step, start + place * step, clock, sleep

    def wait(self, skipped: int = 0) -> None:
        """Waits for the next slot, leaving out as many as told."""
        at = self.next + skipped * self.step
        if (left := at - self._clock()) > 0:
            self._sleep(left)
        self.next = max(at, self._clock()) + self.step


def fetched(fetch: Callable[[str, int], dict], task: str, page: int, attempts: int, pace: Pace) -> Iterator[tuple]:
    """The row about a page and those of its records. After the k-th failure k slots are left out."""
    answer, calls = {"status": "error", "message": "not tried"}, 0
    while calls < attempts:
        pace.wait(calls)
        calls += 1
        try:
            answer = fetch(task, page)
        except Exception as e:
            answer = {"status": "error", "message": type(e).__name__}
        if (answer.get("status") or OK) in (OK, NO_ROWS):
            break
    status = answer.get("status") or OK
    fine = status in (OK, NO_ROWS)
    total = max(1, int(str(answer.get("total_page") or 1))) if fine else None
    yield task, page, None, None, status, None if fine else str(answer.get("message", "")), total, calls
    if fine:
        for row in page_rows(task, page, answer):
            yield *row, None, None


class SlotPartition(InputPartition):
    def __init__(self, place: int, pages: list):
        self.place, self.pages = place, pages


class SlotReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.dealt = options, json.loads(options["pages"])

    def partitions(self) -> list[SlotPartition]:
        return [SlotPartition(i, pages) for i, pages in enumerate(self.dealt)]

    def read(self, partition: SlotPartition):
        module, _, name = self.options["fetch"].partition(":")
        fetch = getattr(importlib.import_module(module), name)
        pace = Pace(partition.place, len(self.dealt), float(self.options["pace"]), float(self.options["start"]))
        for task, page in partition.pages:
            yield from fetched(fetch, task, page, int(self.options["attempts"]), pace)


class SlotSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_slots"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SlotReader:
        return SlotReader(dict(self.options))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """All that was written, with the number of its batch."""
    return spark.read.schema(f"{SCHEMA}, batch int").parquet(folder) if listed(spark, folder) else spark.createDataFrame([], f"{SCHEMA}, batch int")


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """(task, page_no, status, message, total_page, calls): the last word on each page that was asked for, calls in all."""
    about = pages(spark, folder).filter("row_no is null")
    last = about.groupBy("task", "page_no").agg(F.max_by(F.struct("status", "message", "total_page"), "batch").alias("x"), F.sum("calls").alias("calls"))
    return last.select("task", "page_no", "x.*", "calls")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """(task, page_no, row_no, record) of all pages that succeeded."""
    return pages(spark, folder).filter("row_no is not null").select("task", "page_no", "row_no", "record")


def collect_pages(spark: SparkSession, fetch: str, tasks: Sequence[str], folder: str, attempts: int = 4, pace: float = 0.15, at_once: int = 1000, slots: int | None = None, quota: int | None = None) -> int:
    """Fetches all pages of the tasks that the folder does not hold; the number of calls made.

    A task's first page says how many there are; if it fails, the task waits for the next run. Pages that failed are
    tried again in the next run. With a quota no batch is begun that could exceed it. The driver keeps the numbers of
    pages, no records; they are as many as calls may be made.
    """
    spark.dataSource.register(SlotSource)
    slots = slots or spark.sparkContext.defaultParallelism
    totals: dict[str, int] = {}
    done: set[tuple[str, int]] = set()
    tried: set[tuple[str, int]] = set()
    fine = F.col("status").isin(OK, NO_ROWS)
    for r in ledger(spark, folder).filter(fine).select("task", "page_no", "total_page").toLocalIterator():
        done.add((r.task, r.page_no))
        if r.page_no == 1:
            totals[r.task] = r.total_page
    numbers = [int(x.removeprefix("batch=")) for x in listed(spark, folder) if x.startswith("batch=")]
    number, calls = max(numbers, default=-1) + 1, 0
    while True:
        todo = [(t, p) for t in dict.fromkeys(tasks) for p in range(1, totals.get(t, 1) + 1) if (t, p) not in done and (t, p) not in tried]
        todo = todo[: at_once if quota is None else min(at_once, (quota - calls) // attempts)]
        if not todo:
            return calls
        dealt = [todo[i::slots] for i in range(min(slots, len(todo)))]
        asked = spark.read.format("paged_slots").options(fetch=fetch, pages=json.dumps(dealt), attempts=attempts, pace=pace, start=time.time()).load()
        place = f"{folder}/batch={number:06d}"
        asked.write.mode("overwrite").parquet(place)
        for r in spark.read.schema(SCHEMA).parquet(place).filter("row_no is null").select("task", "page_no", "status", "total_page", "calls").collect():
            tried.add((r.task, r.page_no))
            calls += r.calls
            if r.status in (OK, NO_ROWS) and r.page_no == 1:
                totals[r.task] = r.total_page
        number += 1

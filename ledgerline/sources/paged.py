"""A paged JSON source as a Python data source: a partition for each task, retries with linear backoff, pauses.

Pages come from a callable ``fetch(task, page) -> dict`` that is given by name (``module:function``), so that executors
can import it; no endpoint is built in. Status 000 is fine, 013 means no rows, all else is an error after the retries.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

OK, NO_ROWS = "000", "013"
SCHEMA = "task string, page_no int, row_no int, record string, status string, message string"


def fetch_page(fetch: Callable[[str, int], dict], task: str, page: int, attempts: int = 4, pace: float = 0.15, sleep: Callable[[float], None] = time.sleep) -> dict:
    """A page, tried again after errors that are raised or returned; the last error is returned."""
    answer = {"status": "error", "message": "not tried"}
    for attempt in range(attempts):
        if attempt:
            sleep(pace * attempt)
        try:
            answer = fetch(task, page)
        except Exception as e:
            answer = {"status": "error", "message": type(e).__name__}
        if answer.get("status", OK) in ("", OK, NO_ROWS):
            return answer
    return answer


def page_rows(task: str, page: int, answer: dict) -> list[tuple]:
    status = answer.get("status") or OK
    if status not in (OK, NO_ROWS):
        return [(task, page, None, None, status, str(answer.get("message", "")))]
    listed = answer.get("list") or []
    return [(task, page, i, json.dumps(r, ensure_ascii=False), status, None) for i, r in enumerate([listed] if isinstance(listed, dict) else listed)]


def task_rows(fetch: Callable[[str, int], dict], task: str, attempts: int = 4, pace: float = 0.15, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple]:
    """The rows of all pages of a task, with a pause between pages; page 1 is fetched once and says how many there are.

    A page that fails is a row with its status; if it is page 1, the task ends there, else the next pages follow.
    """
    page = total = 1
    while page <= total:
        if page > 1 and pace:
            sleep(pace)
        answer = fetch_page(fetch, task, page, attempts, pace, sleep)
        yield from page_rows(task, page, answer)
        if page == 1 and (answer.get("status") or OK) in (OK, NO_ROWS):
            total = max(1, int(str(answer.get("total_page", 1) or 1)))
        page += 1


class TaskPartition(InputPartition):
    def __init__(self, task: str):
        self.task = task


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[TaskPartition]:
        """One for each task; planning fetches nothing."""
        return [TaskPartition(task) for task in json.loads(self.options["tasks"])]

    def read(self, partition: TaskPartition):
        module, _, name = self.options["fetch"].partition(":")
        fetch = getattr(importlib.import_module(module), name)
        yield from task_rows(fetch, partition.task, int(self.options.get("attempts", 4)), float(self.options.get("pace", 0.15)))


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))


def read_pages(spark: SparkSession, fetch: str, tasks: list[str], attempts: int = 4, pace: float = 0.15):
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged_json").options(fetch=fetch, tasks=json.dumps(tasks), attempts=attempts, pace=pace).load()

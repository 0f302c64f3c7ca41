"""A search endpoint as a table: predicates on its columns become parameters of the requests.

``equal`` maps columns to parameters, ``ranges`` maps columns to a parameter for the least and one for the greatest value. An
equality, a set or a bound on such a column is sent with every request; what is empty is left out. A set gives a partition
for each value. Spark checks the rows again, so that an endpoint that ignores a parameter gives no wrong rows. A column that
the endpoint takes but does not return holds what was asked for.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Iterable, Mapping, Sequence
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, In, InputPartition, LessThanOrEqual

from .paged import NO_ROWS, OK, fetch_page

MOST_ROWS_A_PAGE = 100


class SearchPartition(InputPartition):
    def __init__(self, parameters: dict[str, str]):
        self.parameters = parameters


class SearchReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns = options, columns
        self.equal, self.ranges = json.loads(options["equal"]), json.loads(options["ranges"])
        self.values: dict[str, list[str]] = {}

    def _narrow(self, parameter: str, values: Iterable) -> None:
        said = [str(v) for v in values if v not in (None, "")]
        own = self.values.get(parameter)
        self.values[parameter] = said if own is None else [v for v in own if v in said]

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes parameters from the filters; all of them are given back, so that Spark applies them, too."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if isinstance(f, EqualTo) and name in self.equal and f.value not in (None, ""):
                self._narrow(self.equal[name], [f.value])
            elif isinstance(f, In) and name in self.equal and not any(v in (None, "") for v in f.value):
                self._narrow(self.equal[name], f.value)
            elif name in self.ranges and isinstance(f, (GreaterThanOrEqual, LessThanOrEqual, EqualTo)) and f.value not in (None, ""):
                low, high = self.ranges[name]
                for parameter, best in (((low, max),) if isinstance(f, GreaterThanOrEqual) else ((high, min),) if isinstance(f, LessThanOrEqual) else ((low, max), (high, min))):
                    self.values[parameter] = [best([str(f.value), *self.values.get(parameter, [])])]
            yield f

    def partitions(self) -> list[SearchPartition]:
        names = list(self.values)
        size = max(1, min(int(self.options.get("size", MOST_ROWS_A_PAGE)), MOST_ROWS_A_PAGE))
        fixed = {k: v for k, v in json.loads(self.options.get("fixed", "{}")).items() if v not in (None, "")} | {"page_count": str(size)}
        return [SearchPartition(fixed | dict(zip(names, values))) for values in product(*self.values.values())]

    def read(self, partition: SearchPartition):
        module, _, name = self.options["fetch"].partition(":")
        fetch = getattr(importlib.import_module(module), name)
        echoed = {c: partition.parameters[p] for c, p in self.equal.items() if p in partition.parameters}
        attempts, pace = int(self.options.get("attempts", 4)), float(self.options.get("pace", 0.15))
        page = total = 1
        while page <= total:
            if page > 1:
                time.sleep(pace)
            answer = fetch_page(lambda _, n: fetch(partition.parameters | {"page_no": str(n)}), "", page, attempts, pace)
            status = answer.get("status") or OK
            if status not in (OK, NO_ROWS):
                raise OSError(f"page {page}: {status} {answer.get('message', '')}")
            rows = answer.get("list") or []
            for row in [rows] if isinstance(rows, dict) else rows:
                yield tuple(None if (v := row.get(c, echoed.get(c))) is None else str(v) for c in self.columns)
            if page == 1:
                total = max(1, int(str(answer.get("total_page") or 1)))
            page += 1


class SearchSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "searched_json"

    def schema(self) -> str:
        return ", ".join(f"`{c}` string" for c in json.loads(self.options["columns"]))

    def reader(self, schema) -> SearchReader:
        return SearchReader(dict(self.options), [f.name for f in schema.fields])


def read_search(spark: SparkSession, fetch: str, columns: Sequence[str], equal: Mapping[str, str] = {}, ranges: Mapping[str, tuple[str, str]] = {}, fixed: Mapping[str, str] = {}, size: int = MOST_ROWS_A_PAGE, attempts: int = 4, pace: float = 0.15) -> DataFrame:
    """The endpoint as a table of texts. ``fetch`` (``module:function``) takes the parameters and gives a page's answer."""
    spark.dataSource.register(SearchSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    said = {"columns": list(columns), "equal": dict(equal), "ranges": {k: list(v) for k, v in ranges.items()}, "fixed": dict(fixed)}
    return spark.read.format("searched_json").options(fetch=fetch, size=size, attempts=attempts, pace=pace, **{k: json.dumps(v) for k, v in said.items()}).load()

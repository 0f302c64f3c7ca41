"""Filtered, sorted, paged search; lookups by parameters; statement and indicator groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_ROWS_A_PAGE = 100


@dataclass(frozen=True)
class Page:
    rows: DataFrame
    total: int
    page: int
    pages: int

    @property
    def next_page(self) -> int | None:
        return self.page + 1 if self.page < self.pages else None


def matching(df: DataFrame, equal: Mapping[str, object] = {}, ranges: Mapping[str, tuple] = {}) -> DataFrame:
    """Rows that meet the parameters given; None and the empty string are no parameter. All predicates reach the scan."""
    for name, value in equal.items():
        if value not in (None, ""):
            df = df.filter(F.col(name).isin(*value) if isinstance(value, (list, tuple, set)) else F.col(name) == value)
    for name, (low, high) in ranges.items():
        if low not in (None, ""):
            df = df.filter(F.col(name) >= low)
        if high not in (None, ""):
            df = df.filter(F.col(name) <= high)
    return df


def ordered_page(df: DataFrame, order: Sequence[Column], page: int = 1, size: int = MOST_ROWS_A_PAGE) -> DataFrame:
    """One page: Spark sorts for the rows up to the page's end alone, not the whole table."""
    size = max(1, min(size, MOST_ROWS_A_PAGE))
    return df.orderBy(*order).offset((max(page, 1) - 1) * size).limit(size)


def search(df: DataFrame, equal: Mapping[str, object] = {}, ranges: Mapping[str, tuple] = {}, order: Sequence[Column] = (), page: int = 1, size: int = MOST_ROWS_A_PAGE) -> Page:
    found, size = matching(df, equal, ranges), max(1, min(size, MOST_ROWS_A_PAGE))
    total = found.count()
    return Page(ordered_page(found, order, page, size), total, page, max(1, -(-total // size)))


def in_classes(df: DataFrame, column: str, classes: Sequence[str]) -> DataFrame:
    """Rows of the classes; no classes: all rows. A null class is the empty string."""
    wanted = [c.strip() for c in classes if c.strip()]
    return df.filter(F.coalesce(F.col(column), F.lit("")).isin(*wanted)) if wanted else df


def without_markers(df: DataFrame, column: str, markers: Sequence[str]) -> DataFrame:
    """Rows whose name holds none of the markers; a null name holds none."""
    for marker in markers:
        df = df.filter(~F.coalesce(F.col(column).contains(marker), F.lit(False)))
    return df


def required(**values: str | None) -> None:
    """An error that names the first argument that is missing or blank, before anything is read."""
    for name, value in values.items():
        if value is None or not str(value).strip():
            raise ValueError(f"{name} is required")


def parse_list(said: str) -> list[str]:
    """The parts of a comma list, stripped, without blank ones."""
    return [p.strip() for p in said.split(",") if p.strip()]


def of_companies(df: DataFrame, codes: str, column: str = "corp_code") -> DataFrame:
    """The rows of one company or of a comma list of companies; no code is an error."""
    required(**{column: codes})
    return df.filter(F.col(column).isin(*parse_list(codes)))


def write_dataset(df: DataFrame, path: str, by: str = "report_type") -> None:
    """One folder for each type of report, so that reads of one type touch no other."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def read_dataset(spark: SparkSession, path: str, kind: str, known: Mapping[str, str], codes: str, dates: tuple[str, str] = ("", ""), by: str = "report_type", day: str = "rcept_dt", **equal: object) -> DataFrame:
    """One company's reports of one type, in a range of dates: the type prunes folders, the rest reaches the scan."""
    dataset_of(kind, known)
    found = of_companies(spark.read.parquet(path).filter(F.col(by) == kind), codes)
    return matching(found, equal, {day: dates})


def limited(df: DataFrame, pos: str, n: int | None) -> DataFrame:
    return df if n is None else df.orderBy(pos).limit(max(0, n))


def dataset_of(name: str, registry: Mapping[str, str]) -> str:
    """The dataset of a report type; an unknown type names the known ones."""
    if name not in registry:
        raise ValueError(f"unknown type {name!r}; known: {', '.join(registry)}")
    return registry[name]


def union_branches(branches: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column that a branch lacks is null."""
    first, *rest = branches
    for branch in rest:
        first = first.unionByName(branch, allowMissingColumns=True)
    return first


def answered(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, error) of several scans at once (with ``status`` and ``message``): scans that failed are left out.

    ``error`` has one row, the last failure's status and message, only if no scan gave a row.
    """
    fine = F.coalesce("status", F.lit("")).isin("", "000", "013")
    rows = pages.filter(fine & (F.coalesce("status", F.lit("")) != "013")).drop("status", "message")
    failed = pages.filter(~fine).agg(F.max_by(F.struct("status", "message"), "task").alias("x")).filter("x is not null").select("x.*")
    return rows, failed.join(rows.limit(1), how="left_anti")


def explode_groups(payload: DataFrame, raw: str = "payload") -> DataFrame:
    """Rows of a registration payload: lists inside groups, which win when there are any, else the flat list."""
    shape = "struct<group:array<struct<title:string,list:array<map<string,string>>>>,list:array<map<string,string>>>"
    parsed = payload.withColumn("__p", F.from_json(raw, shape))
    flat = F.array(F.struct(F.lit("").alias("title"), F.col("__p.list").alias("list")))
    groups = F.when(F.size(F.coalesce("__p.group", F.array().cast("array<struct<title:string,list:array<map<string,string>>>>"))) > 0, F.col("__p.group")).otherwise(flat)
    return parsed.withColumn("__g", F.explode(groups)).select(*payload.columns, F.col("__g.title").alias("title"), F.explode("__g.list").alias("record"))

"""JSON lines and manifests: torn lines become rows of their own instead of errors."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dictionaries import CORRECTION_MARKERS
from ..functions.text import strip
from ..operators.search import without_markers
from . import elements

BROKEN = "_corrupt_record"


def read_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, corrupt lines) of a JSON-lines file; blank lines are skipped, lines that are no objects are corrupt.

    ``line_no`` orders lines inside one file's partition; store an explicit position where order matters across files.
    """
    raw = spark.read.text(path).filter(F.trim("value") != "").withColumn("line_no", F.monotonically_increasing_id())
    parsed = raw.withColumn("x", F.from_json("value", f"{schema}, {BROKEN} string", {"columnNameOfCorruptRecord": BROKEN}))
    fine = F.col(f"x.{BROKEN}").isNull() & F.ltrim("value").startswith("{")
    return parsed.filter(fine).select("line_no", "x.*").drop(BROKEN), parsed.filter(~fine).select("line_no", "value")


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, at) of the lines of a file or a folder that are not blank; ``at`` orders lines within and across files.

    It is the file's path, the place of the block that the line was read from, and the line's number in the reading of it: the
    order is that of names and places, in whatever order tasks read them.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("n"))
    return raw.filter(F.trim("value") != "").select("value", F.struct(F.col("f").alias("file"), F.col("b").alias("block"), F.col("n").alias("line")).alias("at"))


def read_manifest(spark: SparkSession, path: str, row: str) -> DataFrame:
    """The records of a manifest with their position, read one by one; a manifest without a list of records is an error.

    That is told at once. A manifest that is torn further on is an error when it is read.
    """
    try:
        read = elements.json_elements(spark, path, "records")
        read.limit(1).collect()
    except Exception as e:
        raise ValueError(f"{path}: no list of records") from e
    return read.select("pos", F.from_json("value", f"struct<{row}>").alias("r")).select("pos", "r.*")


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of strings with positions; blank entries go."""
    text = F.get_json_object(F.concat(F.lit('{"x":'), F.col("value"), F.lit("}")), "$.x")
    return elements.json_elements(spark, path).select("pos", F.trim(text).alias("rcept_no")).filter("rcept_no <> ''")


def read_filings(spark: SparkSession, path: str, exclude_corrections: bool = False) -> DataFrame:
    """(pos, rcept_no, corp_code, corp_name, report_name) of a manifest; blank receipt numbers go, corrections if asked."""
    rows = read_manifest(spark, path, "rcept_no: string, corp_code: string, corp_name: string, report_name: string").na.fill("")
    found = without_markers(rows, "report_name", CORRECTION_MARKERS) if exclude_corrections else rows
    return found.withColumn("rcept_no", strip(F.col("rcept_no"))).filter("rcept_no <> ''")


def read_tag_map(lines: DataFrame, pos: str, line: str = "value") -> DataFrame:
    """(rcept_no, tags), the last line of each receipt number.

    Lines are left out that are no JSON, no object, without a receipt number that is a text, or without a list of tags.
    """
    value = F.try_parse_json(F.col(line))
    of = lambda path: F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    fine = F.schema_of_variant(value).startswith("OBJECT") & (of("$.rcept_no") == "STRING") & of("$.tags").startswith("ARRAY")
    told = lines.filter(F.coalesce(fine, F.lit(False))).select(F.col(pos).alias("pos"), F.try_variant_get(value, "$.rcept_no", "string").alias("rcept_no"), F.try_variant_get(value, "$.tags", "array<string>").alias("tags"))
    return told.filter("rcept_no <> ''").groupBy("rcept_no").agg(F.max_by("tags", "pos").alias("tags"))


def write_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON object a line, null fields kept."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def write_merged(df: DataFrame, path: str, source: str) -> None:
    """Lines in another place than they came from: writing over the source is an error."""
    plain = lambda p: os.path.normpath(p.removeprefix("file:")).rstrip("/")
    if plain(path) == plain(source):
        raise ValueError("the output would replace its own input")
    write_lines(df, path, "overwrite")


def write_array(df: DataFrame, path: str, order: str) -> None:
    """JSON arrays: one for each file, rows in order from file to file; a small table is one file and so one array.

    Each file is a valid array for itself, so that no task needs the whole table. Spark's committer replaces the folder.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            for value in frame["value"]:
                yield pd.DataFrame({"value": ["[" if held is None else held + ","]})
                held = value
        yield pd.DataFrame({"value": ["[]"] if held is None else [held, "]"]})

    lines = df.orderBy(order).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    lines.mapInPandas(run, "value string").write.mode("overwrite").text(path)


def write_summary(row: DataFrame, path: str) -> None:
    """A one-row table as one JSON object, nulls kept; it replaces what was there."""
    write_lines(row.limit(1).coalesce(1), path, "overwrite")

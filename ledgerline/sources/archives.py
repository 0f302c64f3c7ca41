"""ZIP archives as tables: one row for each XML entry; a damaged archive is a row with an error."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.facts import document_head, entry_kind
from . import elements
from .elements import ENTRY


def explode_archives(files: DataFrame) -> DataFrame:
    """Entries of (path, content) archives, one at a time: ``elements.archive_entries`` tells what becomes of damaged ones."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for path, content in zip(*batch.columns):
                yield from elements.batches(elements.archive_entries(path.as_py(), io.BytesIO(content.as_py() or b"")), elements.ENTRIES)

    return files.select("path", "content").mapInArrow(run, ENTRY)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Classified entries of the archives below a folder."""
    entries = elements.zip_entries(spark, folder)
    name, code = document_head(F.col("content"))
    return entries.withColumn("document_name", name).withColumn("acode", code).withColumn("kind", F.when(F.col("error").isNull(), entry_kind(F.col("document_name"), F.col("acode"))))


def read_master(spark: SparkSession, folder: str) -> DataFrame:
    """(pos, corp_code, corp_name, stock_code, modify_date) of company master archives: the records of the first XML file.

    A missing element is an empty string. An archive that cannot be read is an error.
    """
    broken = elements.zip_entries(spark, folder).filter("error is not null").select("path", "error").limit(1).collect()
    if broken:
        raise ValueError(f"{broken[0].path}: {broken[0].error}")
    names = ("corp_code", "corp_name", "stock_code", "modify_date")
    read = F.from_xml("value", ", ".join(f"{n} string" for n in names), {"ignoreSurroundingSpaces": "false"})
    return elements.zip_rows(spark, folder, "list").withColumn("x", read).select("pos", *(F.coalesce(f"x.{n}", F.lit("")).alias(n) for n in names))


def entry_summary(chosen: DataFrame, archives: DataFrame, include: str = "both") -> DataFrame:
    """(path, kind, requested, found, filename, size) for both kinds of each archive of (path)."""
    wanted = {"audit": ["audit"], "consolidated": ["consolidated"], "both": ["audit", "consolidated"]}[include]
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(k in wanted).alias("requested")) for k in ("audit", "consolidated"))))
    asked = archives.select("path").distinct().select("path", kinds.alias("k")).select("path", "k.*")
    joined = asked.join(chosen, ["path", "kind"], "left")
    found = F.col("requested") & F.col("filename").isNotNull()
    return joined.select("path", "kind", "requested", found.alias("found"), F.when(found, F.col("filename")).alias("filename"), F.when(found, F.col("size")).alias("size"))


def write_entries(entries: DataFrame, path: str) -> None:
    """The entries of archives without an error, one folder for each archive; nothing is written for a damaged one.

    ``archive`` is a text, ``a-`` and the file's name, with a hash of its path: so numbers keep their zeros and archives of one
    name in two folders stay apart. ``path`` is kept.
    """
    name = F.concat(F.lit("a-"), F.regexp_replace(T.base_name(F.col("path")), r"\.[^.]*\z", ""), F.lit("-"), F.lower(F.hex(F.xxhash64("path"))))
    fine = entries.filter("error is null").select(name.alias("archive"), "path", "entry_pos", T.base_name(F.col("filename")).alias("filename"), "size", "content")
    fine.write.mode("overwrite").partitionBy("archive").parquet(path)


def requested_entries(entries: DataFrame, include: str = "both", require_consolidated: bool = False) -> DataFrame:
    """The first audit and the first consolidated entry of each archive, as asked for by ``include``."""
    if include not in ("audit", "consolidated", "both"):
        raise ValueError("include is audit, consolidated or both")
    kinds = ["consolidated"] if require_consolidated else {"audit": ["audit"], "consolidated": ["consolidated"], "both": ["audit", "consolidated"]}[include]
    first = entries.filter(F.col("kind").isin(*kinds)).groupBy("path", "kind").agg(F.min_by(F.struct("entry_pos", "filename", "size"), "entry_pos").alias("x"))
    return first.select("path", "kind", "x.*")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(rcept_no, path, content) of the XML files in one folder for each filing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -2).alias("rcept_no"), "path", "content")

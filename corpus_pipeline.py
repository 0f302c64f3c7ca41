"""The corpus pipeline: language ID, quality rules, near duplicates, secret scans, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet in the shared folder and
read again as the next stage's documents. All but the last return the columns of ``documents``.

Defined results: a null or empty text goes in the first stage, as does a text without letters; a null id stays until a
stage says otherwise (``near_duplicates``: if no row of its text has an id); rows that repeat an id and a text come out as
one; an empty table gives no rows; columns beside ``doc_id``, ``text``, ``lang`` and ``n_chars`` are kept, whatever their
names, until ``packing``, which returns its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.language import keep_identified
from ledgerline.llm.minhash import drop_near_duplicates
from ledgerline.llm.packing import pack
from ledgerline.llm.quality import keep_quality
from ledgerline.llm.queries import vocabulary
from ledgerline.llm.secrets import redact
from ledgerline.session import checkpoint_dir, listed, remove, table
from ledgerline.streaming.incremental import guard_parameters


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are clearly in one of the languages of the table; mixed texts, noise and texts without letters (null and
    empty ones, too) go. Where no row has a language, all texts with letters stay. Null and repeated ids stay."""
    return keep_identified(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forests, which the table of labels calibrates; texts that are null
    or empty go. Without labels, forests reject by a fixed threshold. Null and repeated ids stay."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, and one row of those that repeat its id. Null texts stay; a row with a
    null id stays if no row of its text has an id."""
    return drop_near_duplicates(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and ``n_chars`` of changed texts with them; null and empty texts stay as they are."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences; a null or empty text has the closing id alone."""
    return pack(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("packing", packing),
]
#: Models, hashed sketches and a tokenizer are beyond SQL: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages in order; what a stage wrote goes when the next one has written its own. The last one's rows stay.

    With a ``folder`` of the caller, on storage that driver and executors share, a run that was broken off (a lost driver,
    too) goes on after the last stage that is complete there; the folder serves one table of inputs only. Without one, the
    run has a folder of its own in ``spark.checkpoint.dir``, which goes when a stage fails.
    """
    if folder is not None:
        guard_parameters(spark, f"{folder}/_parameters", {"sf_dir": sf_dir, "stages": [name for name, _ in STAGES]})
        return _staged(spark, sf_dir, folder, STAGES)
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    try:
        return _staged(spark, sf_dir, folder, STAGES)
    except BaseException:
        remove(spark, folder)
        raise


def _staged(spark: SparkSession, sf_dir: str, folder: str, stages: Sequence) -> DataFrame:
    """The last stage's rows; stages up to the last one that is complete in the folder are not run again."""
    places = [f"{folder}/{name}" for name, _ in stages]
    done = max((i + 1 for i, place in enumerate(places) if "_SUCCESS" in listed(spark, place)), default=0)
    for place in places[: max(done - 1, 0)]:
        remove(spark, place)
    docs = spark.read.parquet(places[done - 1]) if done else table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(stages[done:], done):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(places[i])
        if i:
            remove(spark, places[i - 1])
        docs = spark.read.parquet(places[i])
    return docs

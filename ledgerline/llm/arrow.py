"""Small wrappers that run a batch function over documents on the workers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .segments import slices

#: Characters handled at once by a worker: bounds its memory, whatever the number of rows in an Arrow batch. Arrays of
#: 8 bytes a character come to some 40 MB; an executor may hold several workers, idle ones too.
CHARS_AT_ONCE = 250_000
#: Bytes of an Arrow batch, about. Executors hold several copies of a batch outside their heap, workers one or two more.
BATCH_BYTES = "4m"
#: Keys that are ranked for each one that is taken.
SPARE = 4


def bounded_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes, whatever the length of texts; a bound that the session was given stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH_BYTES)


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = CHARS_AT_ONCE) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cuts batches into parts of bounded text, each with its texts as Python strings."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        for a, b in slices(pc.fill_null(pc.utf8_length(batch.column(at)), 0).to_pylist(), most):
            part = batch.slice(a, b - a)
            yield part, part.column(at).to_pylist()
    pa.default_memory_pool().release_unused()  # the worker may stay idle from here on


def smallest(keys: DataFrame, kind: str, rows: int, chars: int) -> DataFrame:
    """(__hash, ``kind``) of each kind's distinct texts with the smallest hashes: ``rows`` of them at most, and so many as
    hold ``chars`` characters in all, but one at least. Long texts come last, so that they do not crowd out the others.

    ``keys`` has __hash, __size and the kind; kinds are few, as their counts are broadcast. Of each kind only the keys in
    the lowest part of the range of hashes, where ``SPARE`` times as many as needed are expected, are ranked at all, so
    that no task reads more than these, however many keys there are.
    """
    own = keys.groupBy(kind, "__hash").agg(F.min("__size").alias("__size")).withColumn("__at", F.shiftrightunsigned("__hash", 11))
    counts = own.groupBy(kind).agg(F.count("*").alias("__n"))
    low = own.join(F.broadcast(counts), kind).filter(F.col("__at").cast("double") * F.col("__n") <= F.lit(float(SPARE * rows * (1 << 53))))
    rank = F.row_number().over(Window.partitionBy(kind).orderBy(F.col("__size") > chars // rows, "__at", "__hash"))
    ranked = low.withColumn("__rank", rank).filter(F.col("__rank") <= rows)
    so_far = F.sum("__size").over(Window.partitionBy(kind).orderBy("__rank"))
    return ranked.withColumn("__so_far", so_far).filter((F.col("__rank") == 1) | (F.col("__so_far") <= chars)).select("__hash", kind)


def grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Joins batches so that no group of equal first columns is cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.column_stack([batch.column(i).to_numpy() for i in range(n_keys)])
        new = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        if held:
            last = [held[-1].column(i)[held[-1].num_rows - 1].as_py() for i in range(n_keys)]
            if (key[0] != last).any():
                new = np.concatenate([[0], new])
        if len(new):
            cut = int(new[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def annotate(docs: DataFrame, make: Callable[[], Callable[[list], list]], schema: str, extra: list = (), id_col: str = "doc_id", text_col: str = "text", most: int = CHARS_AT_ONCE) -> DataFrame:
    """One row per document: its id, the ``extra`` columns, and what the batch function returns.

    ``make`` is called once in each task and gives a function from a list of texts to a list of Arrow arrays, one for
    each column of ``schema`` after the id and the extra columns. Other columns of ``docs`` are not read.
    """
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col), *extra, F.col(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch, texts in pieces(batches, "__text", most):
            made = apply(texts)
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *made], [*batch.schema.names[:-1], *names])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    names = [part.split()[0] for part in schema.split(",")]
    return source.mapInArrow(run, f"{head}, {schema}")


def keep_where(docs: DataFrame, make: Callable[[], Callable[[list], pa.Array]], text_col: str = "text", most: int = CHARS_AT_ONCE) -> DataFrame:
    """The rows of ``docs``, all columns as they are, for which the batch function returns true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch, texts in pieces(batches, text_col, most):
            yield batch.filter(apply(texts))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)

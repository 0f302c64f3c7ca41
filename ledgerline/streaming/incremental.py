"""Incremental runs: new files are processed once, results are upserted, changed run parameters are refused."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import keep_last
from ..session import cut_lineage, listed


def guard_parameters(spark: SparkSession, path: str, parameters: dict) -> None:
    """Notes a run's parameters on first use; refuses to go on with others."""
    said = json.dumps(parameters, sort_keys=True, ensure_ascii=False)
    try:
        kept = [r.value for r in spark.read.text(path).collect()]
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        kept = []
    if not kept:
        spark.createDataFrame([(said,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    elif kept != [said]:
        raise ValueError("the run was begun with other parameters")


def load_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A state table, or an empty one where there is none yet or its files cannot be read."""
    try:
        state = spark.read.schema(schema).parquet(path)
        state.count()
        return state
    except Exception as e:
        if not any(said in str(e) for said in ("PATH_NOT_FOUND", "FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "is not a Parquet file")):
            raise
        return spark.createDataFrame([], schema)


def upsert_state(spark: SparkSession, path: str, schema: str, fresh: DataFrame, key: str) -> DataFrame:
    """The state with fresh rows in place of those with their keys, as a new version beside the old ones; reads it back.

    A version is complete or missing (Spark's committer), so that a crash leaves the last complete one in place.
    """
    version, old = _latest_version(spark, path, schema)
    kept = old.join(fresh.select(key).distinct(), key, "left_anti")
    kept.unionByName(fresh.select(*old.columns)).write.mode("overwrite").parquet(f"{path}/version={version + 1:08d}")
    return _latest_version(spark, path, schema)[1]


def _latest_version(spark: SparkSession, path: str, schema: str) -> tuple[int, DataFrame]:
    complete = [v for v in listed(spark, path) if v.startswith("version=") and "_SUCCESS" in listed(spark, f"{path}/{v}")]
    if not complete:
        return 0, spark.createDataFrame([], schema)
    return int(complete[-1].removeprefix("version=")), load_state(spark, f"{path}/{complete[-1]}", schema)


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The last complete version of a state; empty where there is none."""
    return _latest_version(spark, path, schema)[1]


def upsert_buckets(spark: SparkSession, path: str, schema: str, fresh: DataFrame, key: str, pos: str, buckets: int = 64) -> DataFrame:
    """A state in buckets of its key's hash: only buckets that fresh keys fall into are rewritten; reads the state back.

    Of equal fresh keys the last position wins, over the state in any case; null keys are none. Each bucket is replaced as a
    whole when the job has ended (dynamic partition overwrite); a repeated call with the same rows gives the same state.
    ``pos`` is a column of ``fresh`` alone. The number of buckets stays what it was at first: ``guard_parameters`` keeps it.
    """
    guard_parameters(spark, f"{path}/_parameters", {"key": key, "buckets": buckets})
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
    old = read_buckets(spark, path, schema, with_bucket=True)
    names = [c for c in old.columns if c != "bucket"]
    new = keep_last(fresh.filter(F.col(key).isNotNull()), [key], pos).select(*names).withColumn("bucket", bucket)
    touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # as many as there are buckets
    kept = old.filter(F.col("bucket").isin(*touched)).join(new.select(key), key, "left_anti") if touched else old.limit(0)
    merged = cut_lineage(kept.select(*names, "bucket").unionByName(new))
    if touched:
        merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return read_buckets(spark, path, schema)


def read_buckets(spark: SparkSession, path: str, schema: str, with_bucket: bool = False) -> DataFrame:
    """A state in buckets; empty where there is none."""
    there = any(x.startswith("bucket=") for x in listed(spark, path))
    state = spark.read.schema(f"{schema}, bucket int").parquet(path) if there else spark.createDataFrame([], f"{schema}, bucket int")
    return state if with_bucket else state.drop("bucket")


def run_new_files(spark: SparkSession, source: str, schema: str, transform: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, key: str, pos: str) -> None:
    """Processes the files that were not seen before; of equal keys in the sink the last position wins.

    Each batch is written under its number, so that a batch that is repeated after a crash replaces itself;
    ``latest`` reads the sink with last-wins semantics.
    """

    def write(batch: DataFrame, number: int) -> None:
        keep_last(transform(batch), [key], pos).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    stream = spark.readStream.schema(schema).json(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest(spark: SparkSession, sink: str, key: str, pos: str) -> DataFrame:
    return keep_last(spark.read.parquet(sink), [key], "batch", pos)


def windowed_counts(events: DataFrame, time: str, key: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Tumbling-window counts with a watermark: an addition to the batch semantics."""
    return events.withWatermark(time, late).groupBy(F.window(time, size), key).agg(F.count("*").alias("n"))

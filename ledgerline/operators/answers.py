"""Tagging whose answers are kept as they come: a run that dies costs the calls since its last kept batch, no more.

``folder`` holds ``log``, files of finished answers that tasks write while the run goes on, and ``state``, all answers in
buckets of their key's hash. A run begins and ends by moving the log into the state, so that what a dead run left behind is
found again; only buckets that the log's keys fall into are rewritten. One run at a time may use a folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dictionaries import TAGS
from ..functions.tags import parse_reply
from ..session import cut_lineage, listed, remove
from ..sources.single import arrow_files
from ..streaming.incremental import read_buckets, upsert_buckets
from .tagging import cache_key, targets

LOG = "kam_hash string, reply string, error string, model string, base_url string"
STATE = "kam_hash string, tags array<string>, dropped array<string>, error string, model string, base_url string"


class AnswerLog:
    """The answers of one task: each full batch is a file that appears whole, under a name that tells run and task."""

    def __init__(self, folder: str, own: str, keep_every: int):
        self.files, self.folder = arrow_files(folder)
        self.own, self.keep_every, self.held = own, keep_every, []
        self.files.create_dir(self.folder)

    def known(self) -> set[str]:
        """Keys that an earlier attempt of this task has kept in the same run."""
        from pyarrow.fs import FileSelector

        found: set[str] = set()
        for info in self.files.get_file_info(FileSelector(self.folder)):
            if info.base_name.startswith(self.own):
                with self.files.open_input_stream(info.path) as read:
                    found |= {json.loads(line)["kam_hash"] for line in read.read().splitlines()}
        return found

    def add(self, **row: str | None) -> None:
        self.held.append(json.dumps(row, ensure_ascii=False))
        if len(self.held) >= self.keep_every:
            self.keep()

    def keep(self) -> None:
        if self.held:
            name = f"{self.own}-{uuid.uuid4().hex}.jsonl"
            with self.files.open_output_stream(f"{self.folder}/_{name}") as out:
                out.write(("\n".join(self.held) + "\n").encode())
            self.files.move(f"{self.folder}/_{name}", f"{self.folder}/{name}")
            self.held = []


def ask_kept(texts: DataFrame, call: Callable[[str], str], folder: str, model: str, base_url: str = "", keep_every: int = 20, at_once: int = 4, tasks: int | None = None) -> int:
    """Asks for each (kam_hash, kam_raw) and keeps the answers in ``folder``; the number of calls that tasks finished.

    Each of ``tasks`` tasks has ``at_once`` calls under way. A call that fails is an answer with the name of its exception. A
    task that is run again leaves out what its earlier attempts have kept.
    """
    run = uuid.uuid4().hex

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log = AnswerLog(folder, f"{run}-{TaskContext.get().partitionId():06d}", keep_every)
        known, under_way, calls = log.known(), {}, 0

        def take(done: set[Future]) -> None:
            for future in done:
                error = future.exception()
                if error is not None and not isinstance(error, Exception):
                    raise error
                log.add(kam_hash=under_way.pop(future), reply=None if error else future.result(), error=type(error).__name__ if error else None, model=model, base_url=base_url)

        pool = ThreadPoolExecutor(at_once)
        try:
            for batch in batches:
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if key in known:
                        continue
                    if len(under_way) >= at_once:
                        take(wait(under_way, return_when=FIRST_COMPLETED).done)
                    under_way[pool.submit(call, text)] = key
                    calls += 1
            take(wait(under_way).done)
        finally:
            log.keep()
            pool.shutdown(cancel_futures=True)
        yield pa.RecordBatch.from_pydict({"calls": pa.array([calls], pa.int64())})

    spread = texts.select("kam_hash", "kam_raw").repartition(tasks or texts.sparkSession.sparkContext.defaultParallelism, "kam_hash")
    return spread.mapInArrow(work, "calls long").agg(F.coalesce(F.sum("calls"), F.lit(0))).first()[0]


def settle(spark: SparkSession, folder: str, vocabulary: Sequence[str] = TAGS, buckets: int = 64) -> DataFrame:
    """Moves the log into the state and reads the state. An answer goes before an error, whichever came last."""
    if any(name.endswith(".jsonl") for name in listed(spark, f"{folder}/log")):
        lines = spark.read.schema(LOG).json(f"{folder}/log").withColumn("x", F.when(F.col("error").isNull(), parse_reply(F.col("reply"), vocabulary)))
        fresh = lines.select("kam_hash", "x.tags", "x.dropped", "error", "model", "base_url", F.struct(F.col("error").isNull(), F.coalesce("reply", F.lit(""))).alias("pos"))
        upsert_buckets(spark, f"{folder}/state", STATE, fresh, "kam_hash", "pos", buckets)
        remove(spark, f"{folder}/log")
    return read_buckets(spark, f"{folder}/state", STATE)


def tag_kept(
    facts: DataFrame, call: Callable[[str], str], model: str, tagged_at: str, folder: str, vocabulary: Sequence[str] = TAGS, base_url: str = "", pos: str | None = None,
    keep_every: int = 20, at_once: int = 4, tasks: int | None = None, retry_failed: bool = True, buckets: int = 64,
) -> DataFrame:
    """The sidecar of the facts, one row for each receipt number: tags, dropped, kam_hash, model, base_url, tagged_at, error, cache_hit.

    Each different text is asked for once in the folder's life; texts whose call failed are asked for again by the next run,
    unless ``retry_failed`` is off. A fact without a receipt number is not asked for: its row says ``missing_rcept_no``.
    """
    spark = facts.sparkSession
    state = settle(spark, folder, vocabulary, buckets)
    fine, blank = targets(facts, pos)
    keyed = cut_lineage(fine.select("rcept_no", "kam_raw", cache_key(model, base_url, F.col("kam_raw")).alias("kam_hash")))
    have = state.filter("error is null") if retry_failed else state
    texts = keyed.groupBy("kam_hash").agg(F.first("kam_raw").alias("kam_raw"))
    asked = cut_lineage(texts.join(have.select("kam_hash"), "kam_hash", "left_anti"))
    ask_kept(asked, call, f"{folder}/log", model, base_url, keep_every, at_once, tasks)
    state = settle(spark, folder, vocabulary, buckets)
    new = asked.select("kam_hash", F.lit(True).alias("new"))
    told = keyed.join(state, "kam_hash").join(new, "kam_hash", "left").withColumn("cache_hit", F.col("new").isNull())
    tagged = told.select("rcept_no", "tags", "dropped", "kam_hash", "model", "base_url", F.lit(tagged_at).alias("tagged_at"), "error", "cache_hit")
    missing = blank.select("rcept_no", F.lit(model).alias("model"), F.lit(base_url).alias("base_url"), F.lit(tagged_at).alias("tagged_at"), F.col("status").alias("error"), F.lit(False).alias("cache_hit"))
    return cut_lineage(tagged.unionByName(missing, allowMissingColumns=True))

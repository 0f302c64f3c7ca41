"""Tagging by a callable: each distinct text is asked once, answers are kept under their content hash."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dictionaries import TAGS
from ..functions.tags import parse_reply
from ..functions.text import blank, content_hash
from ..session import cut_lineage
from .dedup import keep_first
from .records import split_blank


def taggable(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("kam_present") & ~blank(F.col("kam_raw")))


def ask(texts: DataFrame, call: Callable[[str], str], text: str) -> DataFrame:
    """Adds ``reply`` and ``error`` (the exception's class, else null): a failing row never ends the job."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            replies, errors = [], []
            for value in frame[text]:
                try:
                    replies.append(call(value))
                    errors.append(None)
                except Exception as e:
                    replies.append(None)
                    errors.append(type(e).__name__)
            yield frame.assign(reply=pd.Series(replies, dtype="object", index=frame.index), error=pd.Series(errors, dtype="object", index=frame.index))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema)
    return texts.mapInPandas(run, f"{kinds}, reply string, error string")


def cache_key(model: str, base_url: str, text: Column) -> Column:
    """The key of an answer: another model or another endpoint is another answer."""
    return content_hash(F.lit(model), F.lit(base_url), text)


def targets(facts: DataFrame, pos: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(facts to tag, facts without a receipt number): of each receipt number the first fact counts.

    Without ``pos`` (from 0) the order of the rows is Spark's own, and blank receipts are numbered in it.
    """
    found = taggable(facts)
    own = found if pos else found.withColumn("__pos", F.monotonically_increasing_id())
    fine, blank = split_blank(own, pos or "__pos")
    return keep_first(fine, ["rcept_no"], pos or "__pos").drop("__pos"), blank.drop("__pos")


def tag(facts: DataFrame, call: Callable[[str], str], model: str, tagged_at: str, cache: DataFrame | None = None, vocabulary: Sequence[str] = TAGS, calls_at_once: int = 4, base_url: str = "", pos: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(tags for each receipt number, new cache entries). Facts whose call failed have null tags and an error.

    Facts without a receipt number are not asked for: their row says ``missing_rcept_no``. The answers are written to the
    checkpoint folder at once, so that no use of the results asks again.
    """
    fine, blank = targets(facts, pos)
    keyed = fine.withColumn("kam_hash", cache_key(model, base_url, F.col("kam_raw")))
    texts = keyed.groupBy("kam_hash").agg(F.first("kam_raw").alias("kam_raw"))
    if cache is not None:
        texts = texts.join(cache.select("kam_hash"), "kam_hash", "left_anti")
    asked = ask(texts.repartition(calls_at_once, "kam_hash"), call, "kam_raw")
    answers = cut_lineage(asked).withColumn("parsed", F.when(F.col("error").isNull(), parse_reply(F.col("reply"), vocabulary)))
    made = [F.lit(model).alias("model"), F.lit(base_url).alias("base_url")]
    fresh = answers.select("kam_hash", "parsed.tags", "parsed.dropped", "error")
    known = fresh.withColumn("cache_hit", F.lit(False))
    if cache is not None:
        known = known.unionByName(cache.select("kam_hash", "tags", "dropped", F.lit(None).cast("string").alias("error"), F.lit(True).alias("cache_hit")))
    tagged = keyed.join(known, "kam_hash").select("rcept_no", "tags", "dropped", "kam_hash", *made, F.lit(tagged_at).alias("tagged_at"), "error", "cache_hit")
    missing = blank.select("rcept_no", F.col("status").alias("error"), F.lit(False).alias("cache_hit"), *made, F.lit(tagged_at).alias("tagged_at"))
    return tagged.unionByName(missing, allowMissingColumns=True), fresh.filter("error is null").drop("error").select("*", *made)

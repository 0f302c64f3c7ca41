"""Keyed deduplication with explicit order: first wins or last wins. One grouped aggregate each, partial before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keep(df: DataFrame, keys: Sequence[str], pos: Sequence[Column], pick) -> DataFrame:
    row = F.struct(*(F.col(c) for c in df.columns))
    return df.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(pick(row, F.struct(*pos)).alias("row")).select("row.*")


def keep_last(df: DataFrame, keys: Sequence[str], *pos: str) -> DataFrame:
    """The row of each key with the greatest position (columns in order); a null key is a key."""
    return _keep(df, keys, [F.col(p) for p in pos], F.max_by)


def keep_first(df: DataFrame, keys: Sequence[str], *pos: str) -> DataFrame:
    return _keep(df, keys, [F.col(p) for p in pos], F.min_by)


def distinct_rows(df: DataFrame, columns: Sequence[str], pos: str) -> DataFrame:
    """Distinct values of the columns with the position where each was seen first."""
    return df.groupBy(*columns).agg(F.min(pos).alias(pos))


def repair(df: DataFrame, key: str, pos: str) -> DataFrame:
    """An append log made whole: blank keys go, each key keeps its last value at its first position (``first_pos``)."""
    row = F.struct(*(F.col(c) for c in df.columns))
    valid = df.filter(F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) != "")
    return valid.groupBy(F.col(key).alias("__key")).agg(F.max_by(row, pos).alias("row"), F.min(pos).alias("first_pos")).select("row.*", "first_pos")

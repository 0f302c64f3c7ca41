"""Date functions, and calendar windows for collection."""

from __future__ import annotations

import re
from calendar import monthrange
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW_MONTHS = 3


def dashed(c: Column) -> Column:
    """``YYYYMMDD`` with dashes; other text as it is (no calendar check)."""
    parts = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return F.when(c.rlike(r"^\d{8}\z"), parts).otherwise(c)


def period_in(c: Column, pattern: str = r"\((\d{4})\.(\d{1,2})\)") -> Column:
    """Struct (year, month) from the first match of a two-group pattern; null without a match."""
    year, month = (F.nullif(F.regexp_extract(c, pattern, i), F.lit("")).try_cast("int") for i in (1, 2))
    return F.when(year.isNotNull(), F.struct(year.alias("year"), month.alias("month")))


def fiscal_period(name: Column, text: Column, received: Column) -> Column:
    """Year and month from the report's name, else the period's end in the text, else the date of receipt."""
    return F.coalesce(
        period_in(F.coalesce(name, F.lit(""))),
        period_in(text, r"(?U)(\d{4})년\s*(\d{1,2})월\s*\d{1,2}일\s*현재"),
        period_in(F.coalesce(received, F.lit("")), r"^(\d{4})(\d{2})\d{2}\z"),
    )


def in_fiscal_scope(year: Column, month: Column, business_year: int, annual: bool) -> Column:
    same = year == business_year
    return same | ((year == business_year + 1) & (month <= 6)) if annual else same


def add_months(day: date, months: int) -> date:
    """The same day some months on, or the last day of that month."""
    year, month = divmod(day.year * 12 + day.month - 1 + months, 12)
    return date(year, month + 1, min(day.day, monthrange(year, month + 1)[1]))


def parse_day(said: str) -> date:
    if not re.fullmatch(r"[0-9]{8}", said):
        raise ValueError("dates are YYYYMMDD")
    return datetime.strptime(said, "%Y%m%d").date()


def windows(start: str, end: str, months: int = WINDOW_MONTHS) -> list[tuple[str, str]]:
    """Inclusive windows of at most ``months`` calendar months; each begins after the last ends."""
    first, last, out = parse_day(start), parse_day(end), []
    if first > last:
        raise ValueError("start lies after end")
    while first <= last:
        until = min(add_months(first, months) - timedelta(days=1), last)
        out.append((f"{first:%Y%m%d}", f"{until:%Y%m%d}"))
        first = until + timedelta(days=1)
    return out


def split_windows(spark: SparkSession, start: str, end: str, months: int = WINDOW_MONTHS) -> DataFrame:
    """(pos, bgn_de, end_de) of ``windows``, for any number of them."""
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(windows(start, end, months))], "pos int, bgn_de string, end_de string")


def day_range(df: DataFrame, day: str) -> tuple[str, str]:
    """The first and the last day of a column of dates, as YYYYMMDD: one row reaches the driver. No dates are an error."""
    first, last = df.agg(F.date_format(F.min(day), "yyyyMMdd"), F.date_format(F.max(day), "yyyyMMdd")).first()
    if first is None:
        raise ValueError(f"{day} holds no dates")
    return first, last


def default_range(start: str, end: str, today: str, years: int = 10) -> tuple[str, str]:
    """Missing ends filled in: today, and January 1 some years back. The caller says what day it is."""
    return start or f"{parse_day(today).year - years}0101", end or today

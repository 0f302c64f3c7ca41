"""Counts, summaries, samples and grouped lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import in_fiscal_scope, period_in


def counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def zero_filled_counts(df: DataFrame, key: str, keys: Sequence[str], fold_into: str | None = None) -> DataFrame:
    """A count for each of the keys, 0 where there is none; other values are folded into one key or left out."""
    value = F.when(F.col(key).isin(*keys), F.col(key)).otherwise(F.lit(fold_into))
    found = df.groupBy(value.alias(key)).agg(F.count("*").alias("n"))
    dimension = df.sparkSession.createDataFrame([(k,) for k in keys], f"`{key}` string")
    return F.broadcast(dimension).join(found, key, "left").select(key, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def first_per_group(df: DataFrame, key: str, value: str, pos: str, most: int = 10) -> DataFrame:
    """The first ``most`` values of each key in order of position; Spark cuts groups in each task before the shuffle."""
    ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(pos))).filter(F.col("__n") <= most)
    return ranked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("pos"), F.col(value).alias("value")))).alias("__x")).select(key, F.transform("__x", lambda x: x["value"]).alias("sample"))


def tag_distribution(df: DataFrame, tags: str) -> DataFrame:
    return df.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def groups_in_order(df: DataFrame, keys: Sequence[str], pos: str, header: str) -> DataFrame:
    """Groups in the order they were first seen, with the header of their first row and their size."""
    return df.groupBy(*keys).agg(F.min(pos).alias("first_pos"), F.min_by(header, pos).alias("header"), F.count("*").alias("n")).orderBy("first_pos", *keys)


def with_groups(df: DataFrame, keys: Mapping[str, Column], pos: str, headers: Mapping[str, Column] = {}) -> DataFrame:
    """All rows, each with its group's keys, ``group_pos`` (where the group was first seen) and its first row's headers.

    Rows in order of (group_pos, pos) are the groups in the order in which they were first seen. A group is summed up
    before the shuffle and joined back, so that no task needs a whole group.
    """
    keyed = df.withColumns(dict(keys))
    first = keyed.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.min(pos).alias("group_pos"), *(F.min_by(c, pos).alias(n) for n, c in headers.items()))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return keyed.join(first, same).drop(*(f"__{k}" for k in keys))


def _or(name: str, other: Column | str) -> Column:
    return F.coalesce(F.col(name), F.lit(other) if isinstance(other, str) else other)


#: Headers of the periods where the first row of a group names none, and the class without a name.
PERIODS = {"thstrm_nm": "당기", "frmtrm_nm": "전기", "bfefrmtrm_nm": ""}
NO_CLASS = "기타"


def statement_groups(accounts: DataFrame, pos: str, full: bool = False, companies: bool = False, names: Mapping[str, str] = {}) -> DataFrame:
    """Accounts by statement (``full``: by its code; ``companies``: by company first), with the first row's periods.

    ``third_period`` tells whether the first row of the group names one. ``names`` are the statements' names by code.
    """
    sj = _or("sj_nm", F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), F.col("sj_div")), F.col("sj_div")) if names else F.col("sj_div"))
    fs = _or("fs_nm", F.col("fs_div"))
    coded = F.concat(_or("sj_div", ""), F.lit(":"), F.coalesce(sj, F.lit("")))
    keys = {"statement": coded} if full or companies else {"statement": F.concat(F.coalesce(fs, F.lit("")), F.lit(" - "), F.coalesce(sj, F.lit("")))}
    if companies:
        keys = {"company": F.concat(F.coalesce(_or("corp_name", F.col("stock_code")), F.lit("")), F.lit(" ("), F.coalesce(fs, F.lit("")), F.lit(")"))} | keys
    made = with_groups(accounts, keys, pos, {f"first_{n}": _or(n, d) for n, d in PERIODS.items()})
    return made.withColumn("third_period", F.col("first_bfefrmtrm_nm") != "")


def indicator_groups(indicators: DataFrame, pos: str, companies: bool = False) -> DataFrame:
    """Indicators by class (``companies``: by company first); a value that is missing is a dash."""
    named = indicators.withColumn("idx_val", _or("idx_val", "-"))
    keys = {"class": _or("idx_cl_nm", NO_CLASS)}
    return with_groups(named, ({"company": _or("corp_name", "")} if companies else {}) | keys, pos)


def latest_of_periods(df: DataFrame, key: str, period: Column, order: Column, value: str) -> DataFrame:
    """(key, first, last): of each period the last value, then those of the earliest and the latest period."""
    last = df.groupBy(key, period.alias("__period")).agg(F.max_by(value, order).alias("__value"))
    return last.groupBy(key).agg(F.min_by("__value", "__period").alias("first"), F.max_by("__value", "__period").alias("last"))


#: Opinions that a summary always counts.
OPINIONS = ("적정", "한정", "부적정", "의견거절", "unknown")


def extraction_summary(results: DataFrame, samples: int = 10) -> DataFrame:
    """(section, key, n, sample) of an extraction: totals, errors by kind, opinions (0 where there are none), classes.

    ``results`` has pos, rcept_no, status (ok or the kind of error), audit_opinion, going_concern, kam_present and
    corp_cls. Samples are the first receipt numbers of each kind of error.
    """
    ok, none = F.col("status") == "ok", F.array().cast("array<string>")
    good, bad = results.filter(ok), results.filter(~ok)
    sums = results.agg(F.count("*").alias("total_selected"), F.count_if(ok).alias("parsed_ok"), F.count_if(~ok).alias("failed"), F.count_if(ok & F.col("going_concern")).alias("going_concern_true"), F.count_if(ok & F.col("kam_present")).alias("kam_present"))
    totals = sums.unpivot([], ["total_selected", "parsed_ok", "failed", "going_concern_true", "kam_present"], "key", "n").select(F.lit("total").alias("section"), "key", "n", none.alias("sample"))
    first = first_per_group(bad, "status", "rcept_no", "pos", samples)
    errors = bad.groupBy("status").agg(F.count("*").alias("n")).join(first, "status").select(F.lit("error").alias("section"), F.col("status").alias("key"), "n", "sample")
    opinions = zero_filled_counts(good, "audit_opinion", OPINIONS, OPINIONS[-1]).select(F.lit("opinion").alias("section"), F.col("audit_opinion").alias("key"), "n", none.alias("sample"))
    classes = good.groupBy(F.when(F.coalesce("corp_cls", F.lit("")) == "", "unknown").otherwise(F.col("corp_cls")).alias("key")).agg(F.count("*").alias("n")).select(F.lit("class").alias("section"), "key", "n", none.alias("sample"))
    return totals.unionByName(errors).unionByName(opinions).unionByName(classes)


def tagging_summary(tagged: DataFrame) -> DataFrame:
    """(section, key, n): facts tagged and failed, dropped tags, cache hits, then each tag's count.

    ``tagged`` has tags, dropped, error (null where it went well) and cache_hit.
    """
    ok = F.col("error").isNull()
    sums = tagged.agg(F.count("*").alias("targets"), F.count_if(ok).alias("tagged_ok"), F.count_if(~ok).alias("failed"), F.coalesce(F.sum(F.when(ok, F.size("dropped"))), F.lit(0)).cast("long").alias("dropped_total"), F.count_if(ok & F.col("cache_hit")).alias("cache_hits"))
    totals = sums.unpivot([], ["targets", "tagged_ok", "failed", "dropped_total", "cache_hits"], "key", "n").select(F.lit("total").alias("section"), "key", "n")
    return totals.unionByName(tag_distribution(tagged.filter(ok), "tags").select(F.lit("tag").alias("section"), F.col("tag").alias("key"), "n"))


#: The codes of opinions in the short form; all others are blank.
OPINION_CODES = {"적정": "10", "한정": "20", "부적정": "30", "의견거절": "40"}


def short_form(facts: DataFrame, accounts: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row for each fact: its period, its opinion's code, and a column for each account, in thousands.

    ``accounts`` has corp_code, account_nm, fs_div (CFS or OFS) and thstrm_amount; consolidated amounts go first.
    ``columns`` maps account names to the names of the columns.
    """
    plain = F.regexp_replace(F.col("thstrm_amount"), ",", "").try_cast("decimal(38,0)")
    amounts = []
    for account, name in columns.items():
        of = lambda kind, account=account: F.max(F.when((F.col("account_nm") == account) & (F.col("fs_div") == kind), plain))
        amounts.append(F.floor(F.coalesce(of("CFS"), of("OFS")) / 1000).cast("long").alias(name))
    wide = accounts.filter(F.col("account_nm").isin(*columns)).groupBy("corp_code").agg(*amounts)
    month = F.concat(F.col("fiscal_year").cast("string"), F.lpad(F.col("settlement_month").cast("string"), 2, "0"))
    code = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in OPINION_CODES.items() for x in kv)), F.col("audit_opinion")), F.lit(""))
    return facts.join(wide, "corp_code", "left").select("corp_code", "rcept_no", F.coalesce(month, F.lit("")).alias("period"), code.alias("opinion_code"), *columns.values())


def latest_report(reports: DataFrame, business_year: int, code: str, keyword: str) -> DataFrame:
    """One row (rcept_no) or none: the report of a fiscal period among ``report_nm, rcept_dt, rcept_no, pos``.

    Annual and half-year: the latest period, of it the latest receipt, of equal ones the last row. Quarters: of each
    period the latest receipt (of equal ones the first row), then the earliest period for the first quarter, else the
    latest.
    """
    found = reports.filter(F.col("report_nm").contains(keyword)).withColumn("__p", period_in(F.col("report_nm"), r"\((\d{4})[./-](\d{2})\)"))
    found = found.filter(in_fiscal_scope(F.col("__p.year"), F.col("__p.month"), business_year, code == "11011"))
    if code in ("11011", "11012"):
        best = F.max_by("rcept_no", F.struct("__p", "rcept_dt", "pos"))
        return found.agg(best.alias("rcept_no")).filter("rcept_no is not null")
    by_period = found.groupBy("__p").agg(F.max_by("rcept_no", F.struct(F.col("rcept_dt"), -F.col("pos"))).alias("rcept_no"))
    pick = F.min_by if code == "11013" else F.max_by
    return by_period.agg(pick("rcept_no", "__p").alias("rcept_no")).filter("rcept_no is not null")


def completeness(*present: Column) -> Column:
    """The share of fields that are present."""
    return sum((p.cast("int") for p in present), F.lit(0)) / F.lit(float(len(present)))


def merge_counts(merged: DataFrame, corrupt: DataFrame | None = None) -> DataFrame:
    """One row: matched, unmatched, corrupt."""
    n_corrupt = F.lit(0) if corrupt is None else F.lit(corrupt.count())
    return merged.agg(F.count_if("matched").alias("matched"), F.count_if(~F.col("matched")).alias("unmatched")).withColumn("corrupt", n_corrupt.cast("long"))

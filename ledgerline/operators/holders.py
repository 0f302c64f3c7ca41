"""Scans of holders' reports and of the standard accounts: one company or one statement, their columns in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import dashed
from . import search

# The columns of reports of large holders, of executives' and main holders' reports, and of standard accounts.
LARGE_HOLDERS = ("rcept_no", "rcept_dt", "corp_code", "corp_name", "report_tp", "repror", "stkqy", "stkqy_irds", "stkrt", "stkrt_irds", "ctr_stkqy", "ctr_stkrt", "report_resn")
EXECUTIVES = (
    "rcept_no", "rcept_dt", "corp_code", "corp_name", "repror", "isu_exctv_rgist_at", "isu_exctv_ofcps", "isu_main_shrholdr", "sp_stock_lmp_cnt",
    "sp_stock_lmp_irds_cnt", "sp_stock_lmp_rate", "sp_stock_lmp_irds_rate",
)
ACCOUNTS = ("sj_div", "account_id", "account_nm", "bsns_de", "label_kor", "label_eng", "data_tp", "ifrs_ref")


def _told(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as texts; a missing value or column is the empty text, the day is written with dashes."""
    value = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in df.columns else F.lit("")
    return df.select(*((dashed(value(c)) if c == "rcept_dt" else value(c)).alias(c) for c in columns))


def large_holders(reports: DataFrame, corp_code: str) -> DataFrame:
    """Reports of holdings of five per cent and more in one company; no code is an error."""
    search.required(corp_code=corp_code)
    return _told(reports.filter(F.col("corp_code") == corp_code.strip()), LARGE_HOLDERS)


def executives(reports: DataFrame, corp_code: str) -> DataFrame:
    """Reports of executives and main holders of one company; no code is an error."""
    search.required(corp_code=corp_code)
    return _told(reports.filter(F.col("corp_code") == corp_code.strip()), EXECUTIVES)


def standard_accounts(accounts: DataFrame, sj_div: str = "BS1") -> DataFrame:
    """The standard accounts of one statement; no statement is an error."""
    search.required(sj_div=sj_div)
    return _told(accounts.filter(F.col("sj_div") == sj_div.strip()), ACCOUNTS)

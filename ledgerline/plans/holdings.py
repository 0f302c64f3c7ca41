"""Queries of the holders' scans, the standard accounts and a merge with corrupt lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, facts, holders, lookup
from ..session import table
from .registry import query


@query(
    """
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS rcept_no, strftime(l_shipdate, '%Y-%m-%d') AS rcept_dt, CAST(l_suppkey AS VARCHAR) AS corp_code, s_name AS corp_name, '' AS report_tp, CAST(l_partkey AS VARCHAR) AS repror,
           CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS stkqy, CASE WHEN l_linestatus = 'F' THEN '-1' ELSE '' END AS stkqy_irds, '' AS stkrt, '' AS stkrt_irds, '' AS ctr_stkqy, '' AS ctr_stkrt, l_returnflag AS report_resn
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_suppkey = 3
    """
)
def large_holders(spark, sf_dir):
    """One supplier's lines as reports of its holders; what the source lacks is empty."""
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("corp_name"))
    reports = table(spark, sf_dir, "lineitem").join(names, "l_suppkey").select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("rcept_no"), F.date_format("l_shipdate", "yyyyMMdd").alias("rcept_dt"), F.col("l_suppkey").cast("string").alias("corp_code"), "corp_name",
        F.col("l_partkey").alias("repror"), F.col("l_quantity").cast("long").alias("stkqy"), F.when(F.col("l_linestatus") == "F", -1).alias("stkqy_irds"), F.col("l_returnflag").alias("report_resn"),
    )
    return holders.large_holders(reports, " 3 ")


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS rcept_no, strftime(o_orderdate, '%Y-%m-%d') AS rcept_dt, CAST(o_custkey AS VARCHAR) AS corp_code, '' AS corp_name, '' AS repror, CASE o_orderstatus WHEN 'O' THEN '' ELSE o_orderstatus END AS isu_exctv_rgist_at,
           o_orderpriority AS isu_exctv_ofcps, '' AS isu_main_shrholdr, '' AS sp_stock_lmp_cnt, '' AS sp_stock_lmp_irds_cnt, '' AS sp_stock_lmp_rate, '' AS sp_stock_lmp_irds_rate
    FROM orders WHERE o_custkey = 7
    """
)
def executive_holders(spark, sf_dir):
    status = F.col("o_orderstatus")
    reports = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("rcept_no"), F.date_format("o_orderdate", "yyyyMMdd").alias("rcept_dt"), F.col("o_custkey").cast("string").alias("corp_code"), F.when(status != "O", status).alias("isu_exctv_rgist_at"), F.col("o_orderpriority").alias("isu_exctv_ofcps"))
    return holders.executives(reports, "7")


@query("SELECT p_type AS sj_div, CAST(p_partkey AS VARCHAR) AS account_id, p_name AS account_nm, '' AS bsns_de, p_brand AS label_kor, '' AS label_eng, '' AS data_tp, '' AS ifrs_ref FROM part WHERE p_type = 'ECONOMY'")
def standard_accounts(spark, sf_dir):
    accounts = table(spark, sf_dir, "part").select(F.col("p_type").alias("sj_div"), F.col("p_partkey").alias("account_id"), F.col("p_name").alias("account_nm"), F.col("p_brand").alias("label_kor"))
    return holders.standard_accounts(accounts, "ECONOMY")


@query(
    """
    SELECT count(*) FILTER (doc_id % 5 < 4 AND hit) AS matched, count(*) FILTER (doc_id % 5 < 4 AND NOT hit) AS unmatched, count(*) FILTER (doc_id % 5 = 4) AS corrupt
    FROM (SELECT d.doc_id, d.doc_id IN (SELECT doc_id FROM labels) AS hit FROM documents d)
    """
)
def merge_counters_with_corrupt(spark, sf_dir):
    """Lines of facts, one of five torn, merged with a sidecar: matched, unmatched and corrupt ones are counted."""
    said = F.col("doc_id").cast("string")
    line = F.concat(F.lit('{"rcept_no":"'), said, F.when(F.col("doc_id") % 5 < 4, F.lit('"}')).otherwise(F.lit("")))
    fine, corrupt = facts.read_facts(table(spark, sf_dir, "documents").select(line.alias("value")))
    sidecar = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("rcept_no"), F.array(F.lit("x")).alias("kam_tags"), "doc_id")
    return aggregates.merge_counts(lookup.merge_left(fine, sidecar, "rcept_no", "kam_tags", "doc_id"), corrupt)

"""Queries of the filings operators: wire rows, reports and logs are built from the tables by a rule of their keys.

The SQL twins say what must come out for each rule; they do not repeat the operators' steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dictionaries as D
from ..functions import dates, tags
from ..functions import text as T
from ..operators import aggregates, collect, facts, records, search, topics
from ..session import table
from ..sources import jsonl
from .registry import LONGER, WORDS, _text, _WINDOWS_SQL, query

URL = "https://filings.example/%s"


def _by_rest(key: Column, n: int, *values: Column | str) -> Column:
    """The value for the key's rest modulo n."""
    out = F.lit(None)
    for i, value in enumerate(values):
        out = F.when(key % n == i, F.lit(value) if isinstance(value, str) else value).otherwise(out)
    return out


def _text_of(column: str) -> Column:
    return F.col(column).cast("string")


@query(
    _WINDOWS_SQL.format("1986-01-31", "2016-01-31").replace("3 MONTH", "1 MONTH")
    + ", days AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS m FROM lineitem GROUP BY ALL)"
    + " SELECT CAST(pos AS INTEGER) AS pos, strftime(a, '%Y%m%d') AS bgn_de, strftime(b, '%Y%m%d') AS end_de, CAST(coalesce(sum(m), 0) AS BIGINT) AS n FROM w LEFT JOIN days ON day BETWEEN a AND b GROUP BY ALL"
)
def window_split_30_years(spark, sf_dir):
    """Months of 30 years, from a day that many months lack, with the lines that were shipped in each."""
    days = table(spark, sf_dir, "lineitem").groupBy(F.date_format("l_shipdate", "yyyyMMdd").alias("day")).agg(F.count("*").alias("m"))
    windows = dates.split_windows(spark, "19860131", "20160131", 1)
    met = windows.join(days, (F.col("day") >= F.col("bgn_de")) & (F.col("day") <= F.col("end_de")), "left")
    return met.groupBy("pos", "bgn_de", "end_de").agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n"))


def _report(key: Column) -> Column:
    """Report texts with one of six opinions; ends with a landmark, so that what follows is no part of the opinion."""
    said = key.cast("string")
    return _by_rest(
        key, 6,
        F.concat(F.lit("머리 감사의견 우리는 공정하게 표시하고 있습니다. 감사의견근거 근거 "), said),
        F.concat(F.lit("한정의견 이 사항을 제외하고는 공정하게 표시하고 있습니다. 강조사항 가나 "), said),
        F.concat(F.lit("의견거절 우리는 의견을 표명하지 않습니다. 기타사항 다라 "), said),
        F.concat(F.lit("부적정의견 공정하게 표시하고 있지 않습니다. "), said, F.lit(". 기타사항 끝")),
        F.concat(F.lit("머리말 "), said, F.lit(" 우리의 의견으로는 재무제표는 적정하게 표시하고 있습니다. 끝")),
        F.concat(F.lit("아무 말 "), said),
    )


_OPINIONS_SQL = """
    SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '적정' WHEN 1 THEN '한정' WHEN 2 THEN '의견거절' WHEN 3 THEN '부적정' WHEN 4 THEN '적정' ELSE 'unknown' END AS opinion,
           CASE o_orderkey % 6 WHEN 0 THEN '감사의견 우리는 공정하게 표시하고 있습니다.' WHEN 1 THEN '한정의견 이 사항을 제외하고는 공정하게 표시하고 있습니다.' WHEN 2 THEN '의견거절 우리는 의견을 표명하지 않습니다.'
                WHEN 3 THEN '부적정의견 공정하게 표시하고 있지 않습니다. ' || o_orderkey || '.' WHEN 4 THEN '우리의 의견으로는 재무제표는 적정하게 표시하고 있습니다.' ELSE '' END AS paragraph FROM orders
"""


@query(_OPINIONS_SQL)
def opinion_paragraph(spark, sf_dir):
    found = table(spark, sf_dir, "orders").select("o_orderkey", _report(F.col("o_orderkey")).alias("text"))
    found = facts.with_landmarks(found, "text").withColumn("own", facts.opinion_paragraph(F.col("text"))).withColumn("paragraph", facts.deciding(F.col("text"), F.col("own")))
    return found.select("o_orderkey", T.classify(F.col("paragraph"), D.OPINION_RULES, D.UNKNOWN).alias("opinion"), "paragraph")


@query(
    f"""
    WITH p AS ({_OPINIONS_SQL}), o AS (SELECT p.*, o_orderkey AS k, strftime(o_orderdate, '%Y%m%d') AS day FROM p JOIN orders USING (o_orderkey))
    SELECT CAST(k AS VARCHAR) AS rcept_no, opinion AS audit_opinion, paragraph AS opinion_snippet, k % 5 = 0 AS going_concern,
           CASE WHEN k % 5 = 0 THEN '의문 ' || k || ' 1. ' || CASE WHEN k % 4 < 2 THEN '대 한' ELSE '민 국' END || ' 회 계 법 인' ELSE '' END AS going_concern_snippet,
           CASE WHEN k % 3 = 0 THEN '수익 인식 ' || k ELSE '' END AS kam_raw, k % 3 = 0 AS kam_present,
           CAST(CASE WHEN k % 2 = 0 THEN '2024' ELSE substr(day, 1, 4) END AS INTEGER) AS fiscal_year, CAST(CASE WHEN k % 2 = 0 THEN '12' ELSE substr(day, 5, 2) END AS INTEGER) AS settlement_month,
           CASE WHEN k % 2 = 0 THEN '대한 회계법인' ELSE '' END AS auditor,
           array_to_string(list_filter([CASE WHEN k % 2 = 0 THEN 'auditor' END, CASE WHEN k % 4 = 2 THEN 'auditor_mismatch' END, 'fiscal_year', CASE WHEN k % 5 = 0 THEN 'going_concern' END,
             CASE WHEN k % 3 = 0 THEN 'kam' END, CASE WHEN opinion <> 'unknown' THEN 'opinion' END], lambda x : x IS NOT NULL), ',') AS parse_flags FROM o
    """
)
def report_facts(spark, sf_dir):
    """The whole parse: markup, opinion, going concern, key matters, period, auditor against signature, flags."""
    key = F.col("o_orderkey")
    matter = F.when(key % 3 == 0, F.concat(F.lit(" <B>핵심감사사항</B> 수익&nbsp;인식 "), key.cast("string"), F.lit(" <B>기타사항</B> 그 밖. "))).otherwise("")
    doubt = F.when(key % 5 == 0, F.concat(F.lit(" <P>계속기업 관련 중요한 불확실성</P> 의문 "), key.cast("string"))).otherwise("")
    content = F.concat(F.lit("<DOC>\n<P>"), F.replace(_report(key), F.lit(" "), F.lit(" \n<SPAN/>")), F.lit("</P>"), matter, doubt, F.lit(" 1. <TD>"), F.when(key % 4 < 2, "대").otherwise("민"), F.lit("</TD><TD>"), F.when(key % 4 < 2, "한").otherwise("국"), F.lit("</TD> 회 계 법 인</DOC>"))
    reports = table(spark, sf_dir, "orders").select(
        key.cast("string").alias("rcept_no"), F.when(key % 2 == 0, "감사보고서 (2024.12)").otherwise("감사보고서").alias("report_name"), F.date_format("o_orderdate", "yyyyMMdd").alias("rcept_dt"),
        F.when(key % 2 == 0, "대한 회계법인").alias("flr_nm"), F.encode(content, "UTF-8").alias("content"),
    )
    found = facts.parse_reports(reports)
    return found.select("rcept_no", "audit_opinion", "opinion_snippet", "going_concern", "going_concern_snippet", "kam_raw", "kam_present", "fiscal_year", "settlement_month", "auditor", F.array_join("parse_flags", ",").alias("parse_flags"))


@query(
    """
    SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS rcept_no, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE '2024' END AS bsns_year, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE '2024년 감사보고서' END AS business_year_label,
           CASE WHEN s_suppkey % 3 = 1 THEN '2024.03' ELSE '' END AS settlement_date, '강조' AS emphasis_matter, s_name AS core_audit_matter FROM supplier
    """
)
def facts_as_records(spark, sf_dir):
    key = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(
        "s_suppkey", key.cast("string").alias("rcept_no"), F.lit("c").alias("corp_code"), F.lit("n").alias("corp_name"), F.lit("Y").alias("corp_cls"), F.when(key % 3 > 0, 2024).alias("fiscal_year"),
        F.when(key % 3 == 1, 3).alias("settlement_month"), F.lit("감사보고서").alias("category"), F.lit("a").alias("auditor"), F.lit("적정").alias("audit_opinion"), F.lit("강조").alias("emphasis_raw"), F.col("s_name").alias("kam_raw"), F.lit("u").alias("source_url"),
    )
    made = facts.to_audit_records(rows)
    return made.select(F.col("rcept_no").cast("long").alias("s_suppkey"), "rcept_no", "bsns_year", "business_year_label", "settlement_date", "emphasis_matter", "core_audit_matter")


@query(
    """
    SELECT CAST(o_custkey % 50 AS VARCHAR) AS corp_code, o_orderstatus AS corp_cls, CASE WHEN o_custkey % 50 % 7 = 0 THEN '' ELSE CAST(o_custkey % 50 AS VARCHAR) END AS rcept_no, 'A ' || o_orderpriority AS auditor,
           '적정 의견' AS audit_opinion, '' AS core_audit_matter, '1999' AS bsns_year, '1999년 사업보고서' AS business_year_label,
           CASE WHEN o_custkey % 50 % 7 = 0 THEN '' ELSE 'https://filings.example/' || (o_custkey % 50) END AS source_url, min(o_orderkey) AS pos FROM orders GROUP BY ALL
    """
)
def audit_records(spark, sf_dir):
    code = (F.col("o_custkey") % 50).cast("string")
    wire = table(spark, sf_dir, "orders").select(
        "o_orderkey", code.alias("corp_code"), F.col("o_orderstatus").alias("corp_cls"), F.when(F.col("o_custkey") % 50 % 7 > 0, code).alias("rcept_no"), F.concat(F.lit(" A \n\t"), "o_orderpriority", F.lit("  ")).alias("adtor"),
        F.lit("적정　 의견").alias("adt_opinion"), F.lit(None).cast("string").alias("core_adt_matter"),
    )
    made = records.audit_records(wire, "o_orderkey", " 1999 ", "11011", URL)
    return made.select("corp_code", "corp_cls", "rcept_no", "auditor", "audit_opinion", "core_audit_matter", "bsns_year", "business_year_label", "source_url", "pos")


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS rcept_no, CASE WHEN o_orderkey % 4 = 0 THEN 'd/' || o_orderkey || '/' || o_orderkey || '_00761.xml' WHEN o_orderkey % 4 = 1 THEN 'd/' || o_orderkey || '/' || o_orderkey || '.xml'
           WHEN o_orderkey % 4 = 2 THEN 'd/' || o_orderkey || '/only.xml' END AS path, CASE WHEN o_orderkey % 4 = 3 THEN 'no_xml' END AS status FROM orders
    """
)
def filings_with_documents(spark, sf_dir):
    """Two audit documents, the filing's own beside another, a sole file, and none or two that say nothing."""
    key, said = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    filings = table(spark, sf_dir, "orders").select(said.alias("rcept_no"), key.alias("k"))
    names = _by_rest(F.col("k"), 4, F.array(F.concat("rcept_no", F.lit("_00760.xml")), F.concat("rcept_no", F.lit("_00761.xml"))), F.array(F.concat("rcept_no", F.lit(".xml")), F.lit("z.xml")), F.array(F.lit("only.xml")), F.when(F.col("k") % 8 == 7, F.array(F.lit("a.xml"), F.lit("b.xml"))))
    files = filings.select("rcept_no", F.explode(names).alias("name")).select("rcept_no", F.concat(F.lit("d/"), "rcept_no", F.lit("/"), "name").alias("path"))
    return records.with_documents(filings.select("rcept_no"), files)


@query("SELECT c_custkey AS pos, CASE WHEN c_custkey % 5 = 0 THEN '__norcept_' || (c_custkey + 1) ELSE CAST(c_custkey AS VARCHAR) END AS rcept_no, CASE WHEN c_custkey % 5 = 0 THEN 'missing_rcept_no' END AS status FROM customer")
def blank_receipts(spark, sf_dir):
    filings = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pos"), F.when(F.col("c_custkey") % 5 == 0, " 　").otherwise(F.concat(F.lit(" "), _text_of("c_custkey"), F.lit("\t"))).alias("rcept_no"))
    fine, blank = records.split_blank(filings, "pos")
    return fine.withColumn("status", F.lit(None).cast("string")).unionByName(blank)


@query("SELECT l_orderkey * 10 + l_linenumber AS pos, l_suppkey AS rcept_no, CASE l_suppkey % 3 WHEN 1 THEN 'skipped_no_consolidated' WHEN 2 THEN 'failed' END AS status FROM lineitem")
def results_in_input_order(spark, sf_dir):
    filings = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), F.col("l_suppkey").alias("rcept_no"))
    kind = _by_rest(F.col("s_suppkey"), 3, F.lit(None).cast("string"), "no_consolidated", "corrupt_zip")
    results = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("rcept_no"), records.status_of(kind).alias("status"))
    return records.in_input_order(filings, results, "pos")


@query(
    """
    SELECT CAST(event_id AS VARCHAR) AS rcept_no, CAST(CASE event_id % 6 WHEN 0 THEN 2024 WHEN 1 THEN 2023 END AS INTEGER) AS fiscal_year, CASE event_id % 6 WHEN 1 THEN '적정' ELSE 'unknown' END AS audit_opinion,
           event_id % 6 = 1 AS kam_present, CASE event_id % 6 WHEN 1 THEN 'a,b' ELSE '' END AS parse_flags FROM events WHERE event_id % 6 IN (0, 1, 5)
    UNION ALL SELECT 'corrupt', CAST(count(*) AS INTEGER), '', false, '' FROM events WHERE event_id % 6 IN (2, 3, 4)
    """
)
def facts_read_back(spark, sf_dir):
    """Lines with defaults, typed values, a torn line, a list, a year that is no number, and one that is null."""
    said = _text_of("event_id")
    line = _by_rest(
        F.col("event_id"), 6,
        F.concat(F.lit('{"rcept_no":"'), said, F.lit('","fiscal_year":"2024"}')),
        F.concat(F.lit(' {"rcept_no":"'), said, F.lit('","fiscal_year":2023,"kam_present":true,"audit_opinion":"적정","parse_flags":["b","a"]}')),
        F.concat(F.lit('{"rcept_no":"'), said), "[1]",
        F.concat(F.lit('{"rcept_no":"'), said, F.lit('","fiscal_year":"x"}')),
        F.concat(F.lit('{"rcept_no":"'), said, F.lit('","fiscal_year":null,"audit_opinion":""}')),
    )
    fine, corrupt = facts.read_facts(table(spark, sf_dir, "events").select(line.alias("value")))
    rows = fine.select("rcept_no", "fiscal_year", "audit_opinion", "kam_present", F.array_join("parse_flags", ",").alias("parse_flags"))
    return rows.unionByName(corrupt.agg(F.lit("corrupt").alias("rcept_no"), F.count("*").cast("int").alias("fiscal_year"), F.lit("").alias("audit_opinion"), F.lit(False).alias("kam_present"), F.lit("").alias("parse_flags")))


@query("SELECT CAST(user_id AS VARCHAR) AS rcept_no, arg_max(CASE WHEN event_id % 6 = 0 THEN 'a' ELSE 'b,' || event_id END, event_id) AS tags FROM events WHERE event_id % 6 IN (0, 3) GROUP BY user_id")
def tag_map(spark, sf_dir):
    """Lines that are taken, and those that are not: no list of tags, a number for a key, a torn line, a blank key."""
    user, said = _text_of("user_id"), _text_of("event_id")
    line = _by_rest(
        F.col("event_id"), 6,
        F.concat(F.lit('{"rcept_no":"'), user, F.lit('","tags":["a"]}')), F.concat(F.lit('{"rcept_no":"'), user, F.lit('","tags":"x"}')), F.concat(F.lit('{"rcept_no":'), user, F.lit(',"tags":["x"]}')),
        F.concat(F.lit('{"rcept_no":"'), user, F.lit('","tags":["b","'), said, F.lit('"]}')), F.concat(F.lit('{"rcept_no":"'), user, F.lit('","tags":["x"]')), '{"rcept_no":"","tags":["x"]}',
    )
    made = jsonl.read_tag_map(table(spark, sf_dir, "events").select("event_id", line.alias("value")), "event_id")
    return made.select("rcept_no", F.array_join("tags", ",").alias("tags"))


_RESULTS_SQL = """
    r AS (SELECT o_orderkey AS k, CASE o_orderkey % 10 WHEN 0 THEN 'no_xml' WHEN 1 THEN 'ValueError' ELSE 'ok' END AS st, CASE o_orderkey % 6 WHEN 0 THEN '한정' WHEN 1 THEN 'other' ELSE '적정' END AS op,
          CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'unknown' ELSE 'K' END AS cls FROM orders)
"""


@query(
    f"""
    WITH {_RESULTS_SQL}, e AS (SELECT st, k, row_number() OVER (PARTITION BY st ORDER BY k) AS n FROM r WHERE st <> 'ok')
    SELECT 'total' AS section, key, n, '' AS sample FROM (SELECT count(*) AS total_selected, count_if(st = 'ok') AS parsed_ok, count_if(st <> 'ok') AS failed, count_if(st = 'ok' AND k % 3 = 0) AS going_concern_true, count_if(st = 'ok' AND k % 4 = 0) AS kam_present FROM r)
      UNPIVOT (n FOR key IN (total_selected, parsed_ok, failed, going_concern_true, kam_present))
    UNION ALL SELECT 'error', st, count(*), array_to_string(list(CAST(k AS VARCHAR) ORDER BY k) FILTER (n <= 10), ',') FROM e GROUP BY st
    UNION ALL SELECT 'opinion', v.o, count(r.k), '' FROM (VALUES ('적정'), ('한정'), ('부적정'), ('의견거절'), ('unknown')) v(o) LEFT JOIN r ON st = 'ok' AND CASE WHEN op = 'other' THEN 'unknown' ELSE op END = v.o GROUP BY v.o
    UNION ALL SELECT 'class', cls, count(*), '' FROM r WHERE st = 'ok' GROUP BY cls
    """
)
def extraction_summary(spark, sf_dir):
    key = F.col("o_orderkey")
    status = F.when(key % 10 == 0, "no_xml").when(key % 10 == 1, "ValueError").otherwise("ok")
    opinion = F.when(key % 6 == 0, "한정").when(key % 6 == 1, "other").otherwise("적정")
    results = table(spark, sf_dir, "orders").select(key.alias("pos"), key.cast("string").alias("rcept_no"), status.alias("status"), opinion.alias("audit_opinion"), (key % 3 == 0).alias("going_concern"), (key % 4 == 0).alias("kam_present"), F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") != "O", "K").alias("corp_cls"))
    return aggregates.extraction_summary(results).withColumn("sample", F.array_join("sample", ","))


@query(
    """
    WITH d AS (SELECT doc_id, coalesce(lang = 'fr', false) AS bad, doc_id % 2 = 0 AS hit, doc_id % 3 AS n FROM documents)
    SELECT 'total' AS section, key, n FROM (SELECT count(*) AS targets, count_if(NOT bad) AS tagged_ok, count_if(bad) AS failed, CAST(coalesce(sum(CASE WHEN NOT bad THEN n END), 0) AS BIGINT) AS dropped_total, count_if(NOT bad AND hit) AS cache_hits FROM d)
      UNPIVOT (n FOR key IN (targets, tagged_ok, failed, dropped_total, cache_hits))
    UNION ALL SELECT 'tag', '손상', count(*) FROM d WHERE NOT bad UNION ALL SELECT 'tag', '리스', count(*) FROM d WHERE NOT bad AND hit
    """
)
def tagging_summary(spark, sf_dir):
    key, hit = F.col("doc_id"), F.col("doc_id") % 2 == 0
    tagged = table(spark, sf_dir, "documents").select(
        F.when(hit, F.array(F.lit("손상"), F.lit("리스"))).otherwise(F.array(F.lit("손상"))).alias("tags"), F.array_repeat(F.lit("x"), (key % 3).cast("int")).alias("dropped"),
        F.when(F.col("lang") == "fr", "TimeoutError").alias("error"), hit.alias("cache_hit"),
    )
    return aggregates.tagging_summary(tagged)


def _accounts(spark, sf_dir) -> DataFrame:
    line = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + line).alias("pos"), F.when(F.col("l_suppkey") % 2 == 0, _text_of("l_suppkey")).alias("corp_name"), F.concat(F.lit("s"), _text_of("l_suppkey")).alias("stock_code"),
        F.col("l_returnflag").alias("fs_div"), F.when(F.col("l_returnflag") == "R", "재무").alias("fs_nm"), F.col("l_linestatus").alias("sj_div"), F.lit(None).cast("string").alias("sj_nm"),
        F.when(line > 1, _text_of("l_partkey")).alias("thstrm_nm"), F.lit(None).cast("string").alias("frmtrm_nm"), F.when(line > 2, "전전기").alias("bfefrmtrm_nm"),
    )


_ACCOUNTS_SQL = """
    a AS (SELECT l_orderkey * 10 + l_linenumber AS pos, CASE WHEN l_suppkey % 2 = 0 THEN CAST(l_suppkey AS VARCHAR) ELSE 's' || l_suppkey END AS corp, CASE l_returnflag WHEN 'R' THEN '재무' ELSE l_returnflag END AS fs, l_linestatus AS sj,
          CASE WHEN l_linenumber > 1 THEN CAST(l_partkey AS VARCHAR) ELSE '당기' END AS th, l_linenumber > 2 AS third FROM lineitem)
"""


@query(f"WITH {_ACCOUNTS_SQL}, g AS (SELECT fs, sj, min(pos) AS group_pos, arg_min(th, pos) AS th, arg_min(third, pos) AS third FROM a GROUP BY fs, sj) SELECT a.pos, a.fs || ' - ' || a.sj AS statement, g.group_pos, g.th AS first_thstrm_nm, '전기' AS first_frmtrm_nm, g.third AS third_period FROM a JOIN g USING (fs, sj)")
def statement_groups(spark, sf_dir):
    return aggregates.statement_groups(_accounts(spark, sf_dir), "pos").select("pos", "statement", "group_pos", "first_thstrm_nm", "first_frmtrm_nm", "third_period")


@query(f"WITH {_ACCOUNTS_SQL}, g AS (SELECT sj, min(pos) AS group_pos, arg_min(th, pos) AS th FROM a GROUP BY sj) SELECT a.pos, a.sj || ':' || CASE a.sj WHEN 'F' THEN '재무상태표' ELSE a.sj END AS statement, g.group_pos, g.th AS first_thstrm_nm FROM a JOIN g USING (sj)")
def full_statement_groups(spark, sf_dir):
    return aggregates.statement_groups(_accounts(spark, sf_dir), "pos", full=True, names={"F": "재무상태표"}).select("pos", "statement", "group_pos", "first_thstrm_nm")


@query(f"WITH {_ACCOUNTS_SQL}, g AS (SELECT corp, fs, sj, min(pos) AS group_pos, arg_min(third, pos) AS third FROM a GROUP BY corp, fs, sj) SELECT a.pos, corp || ' (' || fs || ')' AS company, sj || ':' || sj AS statement, g.group_pos, g.third AS third_period FROM a JOIN g USING (corp, fs, sj)")
def company_statement_groups(spark, sf_dir):
    return aggregates.statement_groups(_accounts(spark, sf_dir), "pos", companies=True).select("pos", "company", "statement", "group_pos", "third_period")


_INDICATORS_SQL = """
    i AS (SELECT event_id AS pos, CAST(user_id AS VARCHAR) AS company, CASE WHEN event_type = 'error' THEN '기타' ELSE event_type END AS class, CASE WHEN event_id % 4 = 0 THEN '-' ELSE CAST(event_id AS VARCHAR) END AS v FROM events)
"""


def _indicators(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("pos"), _text_of("user_id").alias("corp_name"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("idx_cl_nm"), F.when(F.col("event_id") % 4 > 0, _text_of("event_id")).alias("idx_val"))


@query(f"WITH {_INDICATORS_SQL}, g AS (SELECT class, min(pos) AS group_pos FROM i GROUP BY class) SELECT i.pos, class, group_pos, v AS idx_val FROM i JOIN g USING (class)")
def indicator_groups(spark, sf_dir):
    return aggregates.indicator_groups(_indicators(spark, sf_dir), "pos").select("pos", "class", "group_pos", "idx_val")


@query(f"WITH {_INDICATORS_SQL}, g AS (SELECT company, class, min(pos) AS group_pos FROM i GROUP BY company, class) SELECT i.pos, company, class, group_pos, v AS idx_val FROM i JOIN g USING (company, class)")
def company_indicator_groups(spark, sf_dir):
    return aggregates.indicator_groups(_indicators(spark, sf_dir), "pos", companies=True).select("pos", "company", "class", "group_pos", "idx_val")


@query(
    """
    WITH f AS (SELECT CAST(o_orderkey AS VARCHAR) AS r, o_orderkey AS pos, strftime(o_orderdate, '%Y%m%d') AS dt, CAST(strftime(o_orderdate, '%Y') AS INTEGER) AS y, CAST(strftime(o_orderdate, '%m') AS INTEGER) AS m FROM orders WHERE o_custkey <= 40),
    q AS (SELECT y, m, arg_max(r, struct_pack(d := dt, p := -pos)) AS r FROM f WHERE y = 1998 GROUP BY y, m)
    SELECT '11011' AS code, arg_max(r, struct_pack(y := y, m := m, d := dt, p := pos)) AS rcept_no FROM f WHERE y = 1998 OR (y = 1999 AND m <= 6)
    UNION ALL SELECT '11012', arg_max(r, struct_pack(y := y, m := m, d := dt, p := pos)) FROM f WHERE y = 1998
    UNION ALL SELECT '11013', arg_min(r, struct_pack(y := y, m := m)) FROM q UNION ALL SELECT '11014', arg_max(r, struct_pack(y := y, m := m)) FROM q
    """
)
def latest_report(spark, sf_dir):
    """The receipt number of each kind of report of one business year among some companies' filings."""
    filings = table(spark, sf_dir, "orders").filter("o_custkey <= 40").select(F.concat(F.lit("사업보고서 ("), F.date_format("o_orderdate", "yyyy.MM"), F.lit(")")).alias("report_nm"), F.date_format("o_orderdate", "yyyyMMdd").alias("rcept_dt"), _text_of("o_orderkey").alias("rcept_no"), F.col("o_orderkey").alias("pos"))
    return search.union_branches([aggregates.latest_report(filings, 1998, code, "보고서").select(F.lit(code).alias("code"), "rcept_no") for code in ("11011", "11012", "11013", "11014")])


@query(
    """
    SELECT o_orderkey, CAST(CASE o_orderkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS INTEGER) AS n, CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_orderkey AS VARCHAR) END AS a, CASE o_orderkey % 4 WHEN 0 THEN '' END AS b,
           CAST(CASE o_orderkey % 4 WHEN 0 THEN 2 ELSE 0 END AS BIGINT) AS total_count, CAST(CASE o_orderkey % 4 WHEN 0 THEN 3 WHEN 3 THEN 7 ELSE 1 END AS BIGINT) AS total_page FROM orders
    """
)
def page_payload(spark, sf_dir):
    said = _text_of("o_orderkey")
    raw = _by_rest(F.col("o_orderkey"), 4, F.concat(F.lit('{"list":[{"a":"'), said, F.lit('","b":null},{"a":"x"}],"total_count":"2","total_page":3}')), F.concat(F.lit('{"list":{"a":"'), said, F.lit('"},"total_count":""}')), '{"status":"013"}', '{"list":[],"total_page":"7"}')
    page = table(spark, sf_dir, "orders").select("o_orderkey", tags.page_payload(raw).alias("p"))
    first = F.get("p.records", F.lit(0))
    return page.select("o_orderkey", F.size("p.records").alias("n"), F.try_element_at(first, F.lit("a")).alias("a"), F.try_element_at(first, F.lit("b")).alias("b"), "p.total_count", "p.total_page")


@query(
    """
    SELECT o_orderkey, 'bond_amt=1,234.50|nm=-|rcept_dt=' || strftime(o_orderdate, '%Y-%m-%d') || '|stkrt=-|stock_cnt=' || format('{:,}', o_orderkey) || '|thstrm_amount=' || format('{:,}', o_orderkey * 1000) || '|year_dt=2024' AS said FROM orders
    """
)
def formatted_record(spark, sf_dir):
    """Keys that are no data go; dates, amounts and missing values are formatted by the names of their keys."""
    said = _text_of("o_orderkey")
    raw = F.concat(F.lit('{"status":"000","crtfc_key":"k","rcept_dt":"'), F.date_format("o_orderdate", "yyyyMMdd"), F.lit('","thstrm_amount":"'), said, F.lit('000","stock_cnt":'), said, F.lit(',"stkrt":"","nm":null,"bond_amt":"1234.5","year_dt":"2024"}'))
    record = tags.format_record(tags.without_keys(tags.coerce_record(raw)))
    entries = F.array_sort(F.transform(F.map_entries(record), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(entries, "|").alias("said"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '  ' || p_name || ' (' || p_brand || ')' ELSE p_name END AS name FROM part")
def account_names(spark, sf_dir):
    detail = _by_rest(F.col("p_size"), 3, F.col("p_brand"), "-", F.lit(None).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", T.account_name(F.col("p_name"), detail).alias("name"))


@query("SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d') AS rcept_dt FROM orders WHERE o_custkey IN (1, 2, 7, 40) AND strftime(o_orderdate, '%Y%m%d') BETWEEN '19950101' AND '19991231' AND o_orderstatus <> ''")
def reports_in_range(spark, sf_dir):
    filings = table(spark, sf_dir, "orders").withColumn("rcept_dt", F.date_format("o_orderdate", "yyyyMMdd")).withColumn("corp_code", _text_of("o_custkey"))
    return search.matching(search.of_companies(filings, "1, 2,7 ,,40"), {"o_orderpriority": ""}, {"rcept_dt": ("19950101", "19991231")}).select("o_orderkey", "o_custkey", "rcept_dt")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '일반' ELSE '' END AS title, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE 'flat' END AS v FROM customer WHERE c_custkey % 3 < 2 UNION ALL SELECT c_custkey, '둘', 'x' FROM customer WHERE c_custkey % 3 = 0")
def registration_groups(spark, sf_dir):
    """Lists inside groups, which win; a flat list; neither."""
    raw = _by_rest(F.col("c_custkey"), 3, F.concat(F.lit('{"group":[{"title":"일반","list":[{"v":"'), F.col("c_name"), F.lit('"}]},{"title":"둘","list":[{"v":"x"}]}],"list":[{"v":"flat"}]}')), '{"group":[],"list":[{"v":"flat"}]}', '{"status":"013"}')
    found = search.explode_groups(table(spark, sf_dir, "customer").select("c_custkey", raw.alias("payload")))
    return found.select("c_custkey", "title", F.try_element_at("record", F.lit("v")).alias("v"))


@query(
    """
    WITH w AS (SELECT o_custkey AS r, o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN '감사보고서' WHEN 1 THEN '연결감사보고서 (2024.12)' WHEN 2 THEN '[기재정정]감사보고서' ELSE '사업보고서' END AS nm, strftime(o_orderdate, '%Y%m%d') AS dt FROM orders),
    l AS (SELECT r, max(k) AS k, arg_max(nm, k) AS nm, arg_max(dt, k) AS dt FROM w WHERE contains(nm, '감사보고서') AND NOT contains(nm, '[기재정정]') GROUP BY r)
    SELECT CAST(r AS VARCHAR) AS rcept_no, nm AS report_name, dt AS rcept_dt, CASE WHEN contains(nm, '연결감사보고서') THEN '연결감사보고서' ELSE '감사보고서' END AS category, '' AS flr_nm, 'https://filings.example/' || r AS source_url FROM l
    """
)
def collection(spark, sf_dir):
    """Wire rows to a collection: named, filtered by the task's keyword, corrections out, last of each key, classified."""
    key = F.col("o_orderkey")
    wire = table(spark, sf_dir, "orders").select(
        _by_rest(key, 4, "감사보고서", "연결감사보고서 (2024.12)", "[기재정정]감사보고서", "사업보고서").alias("report_nm"), _text_of("o_custkey").alias("rcept_no"), F.date_format("o_orderdate", "yyyyMMdd").alias("rcept_dt"),
        F.lit("감사보고서").alias("name_keyword"), F.lit(0).alias("task_pos"), F.floor(key / 100).alias("page_no"), (key % 100).alias("row_no"),
    )
    made = collect.collect(collect.disclosures(wire, URL), exclude_corrections=True)
    return made.select("rcept_no", "report_name", "rcept_dt", "category", "flr_nm", "source_url")


@query(
    """
    WITH f AS (SELECT l_suppkey AS s, CASE l_returnflag WHEN 'R' THEN 'sales' WHEN 'A' THEN 'assets' ELSE 'debts' END AS a, l_linestatus = 'F' AS cfs, max(l_partkey * 1500) AS v FROM lineitem GROUP BY ALL),
    p AS (SELECT s, a, coalesce(max(v) FILTER (cfs), max(v) FILTER (NOT cfs)) // 1000 AS v FROM f GROUP BY s, a)
    SELECT CAST(s_suppkey AS VARCHAR) AS corp_code, CASE s_suppkey % 4 WHEN 3 THEN '' ELSE '202403' END AS period, CASE s_suppkey % 5 WHEN 0 THEN '10' WHEN 1 THEN '20' WHEN 2 THEN '30' WHEN 3 THEN '40' ELSE '' END AS opinion_code,
           CAST(max(v) FILTER (a = 'sales') AS BIGINT) AS sales, CAST(max(v) FILTER (a = 'assets') AS BIGINT) AS assets, CAST(max(v) FILTER (a = 'debts') AS BIGINT) AS debts FROM supplier LEFT JOIN p ON s = s_suppkey GROUP BY s_suppkey
    """
)
def short_form_export(spark, sf_dir):
    """Accounts pivoted, consolidated amounts first, in thousands; opinions as codes."""
    key = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(_text_of("s_suppkey").alias("corp_code"), _text_of("s_suppkey").alias("rcept_no"), F.when(key % 4 < 3, 2024).alias("fiscal_year"), F.when(key % 4 < 3, 3).alias("settlement_month"), _by_rest(key, 5, "적정", "한정", "부적정", "의견거절", "unknown").alias("audit_opinion"))
    flag = F.col("l_returnflag")
    accounts = table(spark, sf_dir, "lineitem").select(_text_of("l_suppkey").alias("corp_code"), F.when(flag == "R", "매출액").when(flag == "A", "자산총계").otherwise("부채총계").alias("account_nm"), F.when(F.col("l_linestatus") == "F", "CFS").otherwise("OFS").alias("fs_div"), F.format_number(F.col("l_partkey") * 1500, 0).alias("thstrm_amount"))
    return aggregates.short_form(rows, accounts, {"매출액": "sales", "자산총계": "assets", "부채총계": "debts"}).drop("rcept_no")


@query("SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'consolidated' WHEN 1 THEN 'audit' WHEN 2 THEN 'main' WHEN 3 THEN 'main' WHEN 4 THEN 'other' ELSE 'consolidated' END AS kind FROM documents")
def entry_kinds(spark, sf_dir):
    """Names and codes from the head of a document; consolidated before audit, main by code, file name or suffix."""
    key = F.col("doc_id")
    head = _by_rest(key, 6, '<DOCUMENT-NAME ACODE="00761">x</DOCUMENT-NAME>', "<DOCUMENT-NAME>감사보고서</DOCUMENT-NAME>", '<DOCUMENT-NAME ACODE="11011">x</DOCUMENT-NAME>', "<DOCUMENT-NAME>분기보고서</DOCUMENT-NAME>", '<DOCUMENT-NAME ACODE="9">x</DOCUMENT-NAME>', '<DOCUMENT-NAME ACODE="00760">연결감사보고서</DOCUMENT-NAME>')
    files = table(spark, sf_dir, "documents").select("doc_id", F.encode(F.concat(F.lit("<?xml?>"), head, F.coalesce("text", F.lit(""))), "UTF-8").alias("content"), F.concat(F.lit("a/"), _text_of("doc_id"), F.lit("_1.xml")).alias("filename"))
    name, code = facts.document_head(F.col("content"))
    return files.select("doc_id", "filename", name.alias("name"), code.alias("code")).select("doc_id", facts.entry_kind(F.col("name"), F.col("code")).alias("kind"))


@query("SELECT c_custkey, 'GET /list?k=***&id=' || c_custkey || ' ***' AS said, '***' AS k FROM customer")
def hidden_secrets(spark, sf_dir):
    said = F.concat(F.lit("GET /list?k=s3cr3t"), _text_of("c_custkey"), F.lit("&id="), _text_of("c_custkey"), F.lit(" other"))
    parameters = F.create_map(F.lit("k"), _text_of("c_custkey"), F.lit("id"), F.lit("1"))
    return table(spark, sf_dir, "customer").select("c_custkey", T.hide_value(T.hide_parameter(said, "k"), "other").alias("said"), F.element_at(T.hide_key(parameters, "k"), "k").alias("k"))


@query("""SELECT o_orderkey, '[{"role":"system","content":"Choose\\n- 손상: loss\\n- 리스: lease"},{"role":"user","content":"' || o_orderpriority || ' \\"q\\" ' || o_orderkey || '"}]' AS prompt FROM orders""")
def tagging_prompt(spark, sf_dir):
    text = F.concat("o_orderpriority", F.lit(' "q" '), _text_of("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", tags.tagging_prompt("Choose", {"손상": "loss", "리스": "lease"}, text).alias("prompt"))


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(replace(replace(text, 'there', chr(1)), 'then', chr(1)), 'the') THEN 'article' END, CASE WHEN contains(text, ' of ') THEN 'relation' END, CASE WHEN contains(text, 'and') THEN 'joiner' END, CASE WHEN contains(text, 'der') THEN 'german' END, CASE WHEN contains(text, 'los') THEN 'spanish' END, CASE WHEN contains(text, 'les') THEN 'french' END, CASE WHEN contains(text, 'ing') THEN 'more' END, CASE WHEN contains(text, 'heit') THEN 'last' END], lambda x : x IS NOT NULL), ',') AS tags FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)")
def extended_topics(spark, sf_dir):
    """The dictionary with further terms given as text."""
    more = topics.parse_topics("more:ing, last : heit,")
    return _text(spark, sf_dir).select("doc_id", F.array_join(T.terms_found(F.col("text"), [*WORDS, *more], LONGER), ",").alias("tags"))


@query("SELECT event_id, user_id FROM events WHERE event_type NOT IN ('error', 'view')")
def answered_scans(spark, sf_dir):
    """Scans of several classes at once: the one that failed is left out, the one without data gives no rows."""
    kind = F.col("event_type")
    pages = table(spark, sf_dir, "events").select("event_id", "user_id", kind.alias("task"), F.when(kind == "error", "020").when(kind == "view", "013").otherwise("000").alias("status"), F.when(kind == "error", "limit").alias("message"))
    rows, _ = search.answered(pages)
    return rows.select("event_id", "user_id")

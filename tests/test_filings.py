import io
import json
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerline import dictionaries as D
from ledgerline.functions import dates, tags
from ledgerline.functions import text as T
from ledgerline.operators import aggregates, collect, facts, lookup, records, search, tagging, topics
from ledgerline.operators.dedup import repair
from ledgerline.plans import registry
from ledgerline.sources import archives, jsonl, paged
from ledgerline.streaming import incremental

GOOD = "<P>감사의견</P> 우리는 재무제표가 공정하게 표시하고 있습니다. <P>감사의견근거</P> 근거 <B>핵심감사사항</B> 수익&nbsp;인식 <B>기타사항</B> 그 밖. 대 한 회 계 법 인"


def one(df):
    (row,) = df.collect()
    return row


def column(spark, value, f, kind="string"):
    return one(spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y"))).y


REPORTS = [
    (GOOD, "적정", False, True),
    ("한정의견 이 사항을 제외하고는 공정하게 표시하고 있습니다. 강조사항 가 나", "한정", False, False),
    ("의견거절 우리는 의견을 표명하지 않습니다.", "의견거절", False, False),
    ("부적정의견 공정하게 표시하고 있지 않습니다.", "부적정", False, False),
    ("머리말 없이 우리의 의견으로는 재무제표는 적정하게 표시하고 있습니다. 끝", "적정", False, False),
    ("감사의견 공정하게 표시하고 있습니다. 계속기업 관련 중요한 불확실성 의문이 있다", "적정", True, False),
    ("감사의견 공정하게 표시하고 있습니다. 계속기업으로서의 존속능력을 평가할 책임", "적정", False, False),
    ("", "unknown", False, False),
]


def test_reports(spark):
    rows = [(str(i), "감사보고서 (2025.03)", "20250401", bytearray(body.encode()), "대한회계법인") for i, (body, *_) in enumerate(REPORTS)]
    source = spark.createDataFrame(rows, "rcept_no string, report_name string, rcept_dt string, content binary, flr_nm string")
    for r in facts.parse_reports(source).collect():
        assert (r.audit_opinion, r.going_concern, r.kam_present) == REPORTS[int(r.rcept_no)][1:]
        assert (r.fiscal_year, r.settlement_month) == (2025, 3) and "auditor_mismatch" not in r.parse_flags
        found = {"auditor", "fiscal_year"} | ({"opinion"} if r.audit_opinion != "unknown" else set()) | ({"going_concern"} if r.going_concern else set()) | ({"kam"} if r.kam_present else set())
        assert r.parse_flags == sorted(found)


def test_damaged_documents(spark):
    source = spark.createDataFrame([("1", bytearray(b"\xff\xfe<P>x")), ("2", None)], "rcept_no string, content binary")
    assert [r.audit_opinion for r in facts.parse_reports(source).collect()] == ["unknown"] * 2
    assert {r.bsns_year for r in facts.to_audit_records(facts.parse_reports(source)).collect()} == {""}


def test_strings(spark):
    assert column(spark, "\x1c a　 b\x0b ", T.collapse) == "a b"
    assert [column(spark, x, T.amount) for x in (None, "", "-", "1234567", "-1234.5", "abc")] == ["-", "-", "-", "1,234,567", "-1,234.50", "abc"]
    assert column(spark, "리스크와 리스", lambda c: T.has_term(c, "리스", ("리스크",))) and not column(spark, "리스크", lambda c: T.has_term(c, "리스", ("리스크",)))
    assert column(spark, "a?k=s3&b", lambda c: T.hide_parameter(c, "k")) == "a?k=***&b"
    assert [column(spark, x, dates.dashed) for x in ("20240131", "2024", "20249999")] == ["2024-01-31", "2024", "2024-99-99"]


def test_windows(spark):
    rows = [(r.bgn_de, r.end_de) for r in dates.split_windows(spark, "20231130", "20240601").collect()]
    assert rows == [("20231130", "20240228"), ("20240229", "20240528"), ("20240529", "20240601")]
    with pytest.raises(ValueError):
        dates.split_windows(spark, "20240102", "20240101")


REPLIES = [
    ('["손상", "x", "수익인식", "손상"]', ["수익인식", "손상"], ["x"]),
    ('say ```json\n["리스"]\n``` so', ["리스"], []),
    ('noise ["기타"] noise', ["기타"], []),
    ('{"tags": ["리스"]}', ["리스"], []),
    ('"리스"', ["리스"], []),
    ("12345", [], ["12345"]),
    ("", [], ["<empty response>"]),
    ("   zzz ", [], ["zzz"]),
    ('{"kam_tags": ["리스"], "results": ["손상"]}', ["리스"], []),
    ('{"results": "손상"}', [], ['{"results": "손상"}']),
    ('so ```JSON ["손상"] ```', ["손상"], []),
    ("[", [], ["["]),
]


def test_replies(spark):
    source = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(REPLIES)], "i int, x string")
    for r in source.select("i", tags.parse_reply(F.col("x")).alias("y")).collect():
        assert (r.y.tags, r.y.dropped) == REPLIES[r.i][1:], REPLIES[r.i]


def test_latest_report_ties(spark):
    rows = [("사업보고서 (2023.12)", "20240301", "a", 0), ("사업보고서 (2023.12)", "20240301", "b", 1), ("사업보고서 (2024.07)", "20240901", "c", 2), ("분기보고서 (2023.03)", "20230501", "d", 3), ("분기보고서 (2023.03)", "20230501", "e", 4), ("분기보고서 (2023.09)", "20231101", "f", 5)]
    source = spark.createDataFrame(rows, "report_nm string, rcept_dt string, rcept_no string, pos int")
    assert one(aggregates.latest_report(source, 2023, "11011", "사업보고서")).rcept_no == "b"
    assert one(aggregates.latest_report(source, 2023, "11013", "분기보고서")).rcept_no == "d"
    assert one(aggregates.latest_report(source, 2023, "11014", "분기보고서")).rcept_no == "f"
    assert aggregates.latest_report(source, 2020, "11011", "사업보고서").count() == 0


def test_resolution(spark):
    master = spark.createDataFrame([(i, n, f"{i:08d}") for i, n in enumerate(["삼성전자우", "삼성전자", "A삼성전자", "다른"])], "pos int, corp_name string, corp_code string")
    assert [r["rank"] for r in lookup.rank_matches(master, " 삼성전자 ", "corp_name", "pos").collect()] == [0, 1, 2]
    assert one(lookup.resolve(master, "삼성전자", "corp_name", "corp_code", "pos")).code == "00000001"
    assert one(lookup.resolve(master, "삼성", "corp_name", "corp_code", "pos")).status == "ambiguous"
    assert one(lookup.resolve(master, "없음", "corp_name", "corp_code", "pos")).status == "not_found"


def test_repair_and_topics(spark):
    log = spark.createDataFrame([(0, "a", 1), (1, "b", 1), (2, "a", 2), (3, " ", 9)], "pos int, k string, v int")
    assert [(r.k, r.v) for r in repair(log, "k", "pos").orderBy("first_pos").collect()] == [("a", 2), ("b", 1)]
    names = "corp_code corp_name bsns_year rcept_no auditor audit_opinion special_matter emphasis_matter core_audit_matter source_url".split()
    rows = [("c", "n", "2_024", "r", "a", "적정", "", "", "리스크 손상", "u"), ("c", "n", "x", "r", "", "", "", "", "", ""), ("", "n", "2024", "r", "", "", "", "", "", ""), ("c", "n", "2024", " ", "", "", "", "", "", "")]
    cases, rejected = topics.topic_cases(spark.createDataFrame(rows, names), "now")
    case = one(cases)
    assert case.topic_tags == ["손상"] and case.extraction_confidence == 0.75 and case.case_id.startswith("case-c-2024-r-impairment-")
    assert case.source_url == "r" and case.disclosure_snippet == "적정 리스크 손상"
    plain = one(topics.topic_cases(spark.createDataFrame([(" c ", "n", " 2024", " r ", "-", "unknown", "x", "-", "", "u")], names), "now", url="https://f.example/%s")[0])
    assert plain.topic_tags == [] and plain.extraction_confidence == 0.0 and plain.case_id.startswith("case-c-2024-r-general-") and plain.source_url == "https://f.example/r"
    assert sorted(r.reason for r in rejected.collect()) == ["invalid_fiscal_year", "missing_corp_code", "missing_rcept_no"]


def test_registry_membership():
    assert (len(D.PERIODIC_REPORTS), len(D.MAJOR_EVENTS), len(D.SECURITIES), len(D.TAGS), len(D.TOPICS)) == (28, 36, 6, 19, 14)
    assert search.dataset_of("배당", D.PERIODIC_REPORTS) == "alotMatter"
    with pytest.raises(ValueError, match="배당"):
        search.dataset_of("?", D.PERIODIC_REPORTS)


def test_search_pages(spark):
    page = search.search(spark.range(205), {"id": None}, {"id": (5, None)}, [F.desc("id")], page=2, size=500)
    assert (page.total, page.pages, page.next_page, page.rows.first().id) == (200, 2, None, 104)


def test_tagging_asks_each_text_once(spark):
    def reply(text):
        if "fail" in text:
            raise TimeoutError
        return '["리스"]'

    source = spark.createDataFrame([("1", True, "x"), ("2", True, "x"), ("3", True, "fail"), ("4", True, " "), ("5", False, "x")], "rcept_no string, kam_present boolean, kam_raw string")
    tagged, fresh = tagging.tag(source, reply, "m", "now")
    assert {r.rcept_no: (r.tags, r.error) for r in tagged.collect()} == {"1": (["리스"], None), "2": (["리스"], None), "3": (None, "TimeoutError")}
    again, new = tagging.tag(source, reply, "m", "now", cache=fresh)
    assert fresh.count() == 1 and new.count() == 0 and again.count() == 3


def test_tagging_calls_once_for_each_text(spark, tmp_path):
    calls = tmp_path / "calls"

    def reply(text):
        with open(calls, "a") as f:
            f.write(text + "\n")
        return '{"kam_tags": ["리스", "x"]}'

    source = spark.createDataFrame([(str(i), True, t) for i, t in enumerate(["a", "a", "b", "c"])], "rcept_no string, kam_present boolean, kam_raw string")
    tagged, fresh = tagging.tag(source, reply, "m", "now")
    assert tagged.count() == 4 and fresh.count() == 3 and {tuple(r.dropped) for r in tagged.collect()} == {("x",)}
    assert sorted(calls.read_text().split()) == ["a", "b", "c"]
    again, _ = tagging.tag(source, reply, "m", "now", cache=fresh)
    assert {r.cache_hit for r in again.collect()} == {True} and sorted(calls.read_text().split()) == ["a", "b", "c"]


def test_archives(spark, tmp_path):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("1.xml", '<DOCUMENT-NAME ACODE="11011">사업보고서</DOCUMENT-NAME>')
        z.writestr("1_00760.xml", '<DOCUMENT-NAME ACODE="00760">감사보고서</DOCUMENT-NAME>')
        z.writestr("1_00761.xml", "<DOCUMENT-NAME>연결감사보고서</DOCUMENT-NAME>")
        z.writestr("note.txt", "x")
    (tmp_path / "1.zip").write_bytes(raw.getvalue())
    (tmp_path / "2.zip").write_bytes(b"no archive")
    entries = archives.read_archives(spark, str(tmp_path)).cache()
    assert sorted(r.kind for r in entries.filter("error is null").collect()) == ["audit", "consolidated", "main"]
    assert one(entries.filter("error is not null")).error == "BadZipFile"
    chosen = archives.requested_entries(entries)
    assert {r.filename for r in chosen.collect()} == {"1_00760.xml", "1_00761.xml"}
    summary = {(r.path[-5:], r.kind): (r.requested, r.found) for r in archives.entry_summary(archives.requested_entries(entries, "audit"), entries, "audit").collect()}
    assert summary == {("1.zip", "audit"): (True, True), ("1.zip", "consolidated"): (False, False), ("2.zip", "audit"): (True, False), ("2.zip", "consolidated"): (False, False)}
    archives.write_entries(entries, str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.path[-5:], r.filename) for r in written) == [("1.zip", "1.xml"), ("1.zip", "1_00760.xml"), ("1.zip", "1_00761.xml")]
    assert {r.archive[:4] for r in written} == {"a-1-"}
    assert archives.requested_entries(entries, "audit", require_consolidated=True).count() == 1


def test_archives_are_taken_whole_or_not_at_all(spark, tmp_path):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("1.xml", "<A/>")
        z.writestr("2.xml", "<B>some text that is stored as it is</B>")
    broken = raw.getvalue().replace(b"stored as it is", b"STORED as it is")
    rows = [("whole", bytearray(raw.getvalue())), ("broken", bytearray(broken)), ("json", bytearray(b' {"status": "020", "message": "limit"}')), ("none", None)]
    got = sorted((r.path, r.filename or "", r.error or "") for r in archives.explode_archives(spark.createDataFrame(rows, "path string, content binary")).collect())
    assert got == [("broken", "", "BadZipFile"), ("json", "limit", "json"), ("none", "", "BadZipFile"), ("whole", "1.xml", ""), ("whole", "2.xml", "")]


def test_company_master(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "m.zip", "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("CORPCODE.xml", "<?xml version='1.0'?><result><list><corp_code>00126380</corp_code><corp_name>A &amp; B</corp_name><stock_code> </stock_code></list>\n<list><corp_code>2</corp_code><corp_name>나</corp_name><stock_code>005930</stock_code><modify_date>20240101</modify_date></list></result>")
    rows = [tuple(r) for r in archives.read_master(spark, str(tmp_path)).orderBy("pos").collect()]
    assert rows == [(0, "00126380", "A & B", " ", ""), (1, "2", "나", "005930", "20240101")]
    (tmp_path / "bad.zip").write_bytes(b"x")
    with pytest.raises(ValueError, match="bad.zip"):
        archives.read_master(spark, str(tmp_path))


def test_document_trees(spark, tmp_path):
    for name in ("7/7.xml", "7/7_00760.xml", "8/x.xml"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("<A>감사의견 공정하게 표시하고 있습니다.</A>")
    files = archives.read_documents(spark, str(tmp_path))
    filings = spark.createDataFrame([("7",), ("8",), ("9",)], "rcept_no string")
    made = {r.rcept_no: (r.path or "", r.status) for r in records.with_documents(filings, files).collect()}
    assert made["7"][0].endswith("7_00760.xml") and made["8"][1] is None and made["9"] == ("", "no_xml")
    assert {r.audit_opinion for r in facts.parse_reports(files).collect()} == {"적정"}


def test_document_choice(spark):
    files = spark.createDataFrame([("1", "d/1/1.xml"), ("1", "d/1/1_00760.xml"), ("2", "d/2/x.xml"), ("3", "d/3/a.xml"), ("3", "d/3/b.xml"), ("4", "d/4/4.xml"), ("4", "d/4/z.xml")], "rcept_no string, path string")
    assert {r.rcept_no: r.path for r in facts.choose_documents(files).collect()} == {"1": "d/1/1_00760.xml", "2": "d/2/x.xml", "4": "d/4/4.xml"}


def test_lines_and_manifests(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": "1", "v": null}\n\n{"k": "2"\n[1]\n{"k": "3", "v": 7}\n')
    rows, corrupt = jsonl.read_lines(spark, str(tmp_path / "a.jsonl"), "k string, v int")
    assert sorted((r.k, r.v) for r in rows.collect()) == [("1", None), ("3", 7)] and corrupt.count() == 2
    (tmp_path / "m.json").write_text('{"records": [{"rcept_no": "b"}, {"rcept_no": "a"}]}')
    assert [(r.pos, r.rcept_no) for r in jsonl.read_manifest(spark, str(tmp_path / "m.json"), "rcept_no: string").collect()] == [(0, "b"), (1, "a")]
    (tmp_path / "bad.json").write_text("{}")
    with pytest.raises(ValueError):
        jsonl.read_manifest(spark, str(tmp_path / "bad.json"), "rcept_no: string")


def test_filings_and_sinks(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"records": [{"rcept_no": " b ", "report_name": "감사보고서"}, {"rcept_no": " "}, {"rcept_no": "c", "report_name": "[기재정정]감사보고서"}, {"rcept_no": "d", "corp_name": "n"}]}')
    read = lambda **o: [(r.pos, r.rcept_no, r.corp_name) for r in jsonl.read_filings(spark, str(tmp_path / "m.json"), **o).collect()]
    assert read() == [(0, "b", ""), (2, "c", ""), (3, "d", "n")] and read(exclude_corrections=True) == [(0, "b", ""), (3, "d", "n")]
    (tmp_path / "codes.json").write_text('["1", " ", " 2 "]')
    assert [(r.pos, r.rcept_no) for r in jsonl.read_codes(spark, str(tmp_path / "codes.json")).collect()] == [(0, "1"), (2, "2")]
    rows = spark.createDataFrame([(2, None), (1, "é"), (3, "z")], "k int, v string")
    jsonl.write_array(rows.repartition(3), str(tmp_path / "array"), "k")
    files = sorted((tmp_path / "array").glob("part-*"))
    assert [r for f in files for r in json.loads(f.read_text() or "[]")] == [{"k": 1, "v": "é"}, {"k": 2, "v": None}, {"k": 3, "v": "z"}]
    jsonl.write_array(rows.limit(0), str(tmp_path / "array"), "k")
    assert [json.loads(f.read_text() or "[]") for f in (tmp_path / "array").glob("part-*")] in ([], [[]])
    jsonl.write_lines(rows, str(tmp_path / "lines"))
    jsonl.write_lines(rows, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 6
    with pytest.raises(ValueError):
        jsonl.write_merged(rows, f"{tmp_path}/lines/", f"file:{tmp_path}/x/../lines")
    jsonl.write_merged(rows, str(tmp_path / "merged"), str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "merged")).count() == 3


def test_collection_manifest(spark, tmp_path):
    wire = [("감사보고서", "1", "20240101", "감사보고서", 0, 1, 0), ("[기재정정]감사보고서", "2", "20240102", "감사보고서", 0, 1, 1), ("감사보고서 (2024.12)", "1", "20240103", "감사보고서", 0, 2, 0), ("다른", "4", "20240104", "감사보고서", 0, 2, 1), (None, "5", "20240104", "감사보고서", 0, 2, 2)]
    source = spark.createDataFrame(wire, "report_nm string, rcept_no string, rcept_dt string, name_keyword string, task_pos int, page_no int, row_no int")
    made = collect.collect(collect.disclosures(source, "https://f.example/%s"))
    assert [(r.rcept_no, r.report_name, r.source_url) for r in collect.in_order(made).collect()] == [("2", "[기재정정]감사보고서", "https://f.example/2"), ("1", "감사보고서 (2024.12)", "https://f.example/1")]
    assert {r.category: r.n for r in collect.manifest_counts(made).collect()} == {"감사보고서": 2}
    failed = spark.createDataFrame([("F", "감사보고서", "20240101", "20240331", 2, "limit")], "pblntf_ty string, name_keyword string, bgn_de string, end_de string, page_no int, message string")
    jsonl.write_summary(collect.manifest(made, "now", collect.parse_targets(""), dates.windows("20240101", "20240331"), failed), str(tmp_path / "m"))
    said = json.loads("".join(f.read_text() for f in (tmp_path / "m").glob("part-*")))
    assert (said["total_records"], said["counts_by_category"], said["windows"], said["generated_at"]) == (2, {"감사보고서": 2}, [["20240101", "20240331"]], "now")
    assert said["targets"] == [["F", "감사보고서"], ["A", "사업보고서"]] and said["failed_pages"][0]["page_no"] == 2


def test_parameters_as_text():
    assert collect.parse_targets(" F:감사 , ,A: 사업") == [("F", "감사"), ("A", "사업")] and topics.parse_topics("") == []
    for wrong in ("F", ":x", "F:"):
        with pytest.raises(ValueError):
            collect.parse_targets(wrong)
    assert dates.default_range("", "", "20240229") == ("20140101", "20240229") and dates.default_range("1", "2", "20240101") == ("1", "2")
    assert dates.windows("20240131", "20240430", 1) == [("20240131", "20240228"), ("20240229", "20240328"), ("20240329", "20240428"), ("20240429", "20240430")]
    assert len(dates.windows("19240101", "20240101", 1)) == 1201
    with pytest.raises(ValueError):
        dates.windows("20240230", "20240301")
    with pytest.raises(ValueError, match="corp_code"):
        search.required(bsns_year="2024", corp_code=" ")


def test_datasets_are_pruned(spark, tmp_path):
    rows = [("배당", "1", "20240101"), ("배당", "2", "20240201"), ("배당", "1", "20250101"), ("소액주주", "1", "20240101")]
    search.write_dataset(spark.createDataFrame(rows, "report_type string, corp_code string, rcept_dt string"), str(tmp_path / "d"))
    got = search.read_dataset(spark, str(tmp_path / "d"), "배당", D.PERIODIC_REPORTS, "1", ("20240101", "20241231"))
    assert [(r.corp_code, r.rcept_dt) for r in got.collect()] == [("1", "20240101")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*report_type", plan) and "EqualTo(corp_code,1)" in plan
    with pytest.raises(ValueError, match="배당"):
        search.read_dataset(spark, str(tmp_path / "d"), "?", D.PERIODIC_REPORTS, "1")


def test_failed_scans(spark):
    pages = spark.createDataFrame([("a", None, "020", "limit"), ("b", None, "800", "closed")], "task string, v int, status string, message string")
    rows, error = search.answered(pages)
    assert rows.count() == 0 and [tuple(r) for r in error.collect()] == [("800", "closed")]
    rows, error = search.answered(pages.unionByName(spark.createDataFrame([("c", 1, "000", None)], pages.schema)))
    assert [tuple(r) for r in rows.collect()] == [("c", 1)] and error.count() == 0


RECORDED = """
import json, os

PAGES = {"t": {1: {"status": "000", "total_page": "3", "list": [{"a": "1"}, {"a": "2"}]}, 2: {"status": "800", "message": "closed"}, 3: {"list": {"a": "3"}}}, "none": {1: {"status": "013"}}, "bad": {1: {"status": "020", "message": "limit"}}}


def fetch(task, page):
    with open(os.environ.get("RECORDED_CALLS", "FOLDER/calls"), "a") as f:
        f.write(f"{task} {page}\\n")
    return PAGES[task][page]
"""


def test_pages_are_read_through_spark(spark, tmp_path):
    module = tmp_path / "recorded_pages.py"
    module.write_text(RECORDED.replace("FOLDER", str(tmp_path)).replace("\\\\n", "\\n"))
    spark.sparkContext.addPyFile(str(module))
    rows = paged.read_pages(spark, "recorded_pages:fetch", ["t", "none", "bad"], attempts=2, pace=0.0).collect()
    assert sorted((r.task, r.page_no, r.row_no, r.record, r.status) for r in rows if r.record) == [("t", 1, 0, '{"a": "1"}', "000"), ("t", 1, 1, '{"a": "2"}', "000"), ("t", 3, 0, '{"a": "3"}', "000")]
    assert sorted((r.task, r.page_no, r.status, r.message) for r in rows if not r.record) == [("bad", 1, "020", "limit"), ("t", 2, "800", "closed")]
    calls = sorted((tmp_path / "calls").read_text().split("\n"))[1:]
    assert calls == ["bad 1", "bad 1", "none 1", "t 1", "t 2", "t 2", "t 3"]


def test_pages_have_pauses_between_them():
    waits = []
    pages = {1: {"status": "000", "total_page": 3, "list": []}, 2: {"status": "000"}, 3: {"status": "000", "list": {"a": 1}}}
    assert list(paged.task_rows(lambda task, page: pages[page], "t", 4, 0.5, waits.append)) == [("t", 3, 0, '{"a": 1}', "000", None)] and waits == [0.5, 0.5]


def test_page_retries():
    calls, waits = [], []

    def fetch(task, page):
        calls.append(page)
        if len(calls) == 1:
            raise ConnectionError
        return {"status": "800"} if len(calls) == 2 else {"status": "000", "list": {"a": 1}}

    assert paged.page_rows("t", 1, paged.fetch_page(fetch, "t", 1, 4, 0.5, waits.append)) == [("t", 1, 0, '{"a": 1}', "000", None)]
    assert waits == [0.5, 1.0]
    assert paged.page_rows("t", 1, {"status": "013"}) == [] and paged.page_rows("t", 2, {"status": "020", "message": "m"})[0][4:] == ("020", "m")


def test_windowed_counts(spark):
    events = spark.createDataFrame([("2024-01-01 00:10:00", "a"), ("2024-01-01 00:50:00", "a"), ("2024-01-01 01:10:00", "b")], "t string, k string").withColumn("t", F.col("t").cast("timestamp"))
    assert sorted((r.window.start.hour, r.k, r.n) for r in incremental.windowed_counts(events, "t", "k").collect()) == [(0, "a", 2), (1, "b", 1)]


def test_incremental_runs(spark, tmp_path):
    source, sink = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    run = lambda: incremental.run_new_files(spark, str(source), "k string, pos int", lambda d: d, sink, str(tmp_path / "ck"), "k", "pos")
    (source / "1.json").write_text('{"k": "a", "pos": 1}\n{"k": "b", "pos": 2}\n')
    run()
    (source / "2.json").write_text('{"k": "a", "pos": 3}\n')
    run()
    run()
    assert {r.k: r.pos for r in incremental.latest(spark, sink, "k", "pos").collect()} == {"a": 3, "b": 2}
    empty = lambda: incremental.load_state(spark, str(tmp_path / "state"), "k string, v int")
    assert empty().count() == 0
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "part-0.parquet").write_bytes(b"torn")
    assert empty().count() == 0
    cache, rows = str(tmp_path / "cache"), lambda *r: spark.createDataFrame(r, "k string, v int")
    incremental.upsert_state(spark, cache, "k string, v int", rows(("a", 1), ("b", 1)), "k")
    incremental.upsert_state(spark, cache, "k string, v int", rows(("b", 2), ("c", 2)), "k")
    (tmp_path / "cache" / "version=00000003").mkdir()
    assert {r.k: r.v for r in incremental.read_state(spark, cache, "k string, v int").collect()} == {"a": 1, "b": 2, "c": 2}
    incremental.guard_parameters(spark, str(tmp_path / "p"), {"a": 1})
    incremental.guard_parameters(spark, str(tmp_path / "p"), {"a": 1})
    with pytest.raises(ValueError):
        incremental.guard_parameters(spark, str(tmp_path / "p"), {"a": 2})


def _rows(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = registry.QUERIES[name](spark, folder)
    said = con.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in said.description]
    assert sorted(names) == sorted(got.columns)
    assert _rows(map(tuple, got.select(names).collect())) == _rows(said.fetchall())

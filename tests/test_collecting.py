import json
import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import facts, tagging
from ledgerline.sources import archives, ledger, searched, single

ENDPOINT = '''
import json, os, time

FOLDER = "%s"


def note(name, said):
    with open(os.path.join(FOLDER, name), "a") as f:
        f.write(json.dumps(said) + "\\n")


def fetch(task, page):
    note("calls", [task, page, time.time()])
    total = {"a": 3, "b": 1, "c": 2}.get(task, 5)
    if os.path.exists(os.path.join(FOLDER, f"bad-{task}-{page}")):
        return {"status": "800", "message": "closed"}
    if os.path.exists(os.path.join(FOLDER, "crash")) and page == 2:
        os._exit(9)
    return {"status": "000", "total_page": total, "list": [{"task": task, "n": page * 10 + i} for i in range(2)]}


ROWS = [{"corp_code": str(i %% 3), "corp_cls": "YK"[i %% 2], "rcept_dt": f"2024010{i %% 9 + 1}", "rcept_no": str(i)} for i in range(30)]


def search(parameters):
    note("searches", parameters)
    size, page = int(parameters["page_count"]), int(parameters["page_no"])
    rows = [r for r in ROWS if parameters.get("corp_code", r["corp_code"]) == r["corp_code"] and parameters.get("bgn_de", "") <= r["rcept_dt"] <= parameters.get("end_de", "9")]
    if parameters.get("kind") == "none":
        return {"status": "013"}
    return {"status": "000", "total_page": max(1, -(-len(rows) // size)), "list": rows[(page - 1) * size : page * size]}
'''


@pytest.fixture
def endpoint(spark, tmp_path):
    name = f"endpoint_{tmp_path.name.replace('-', '_')}"
    (tmp_path / f"{name}.py").write_text(ENDPOINT % tmp_path)
    spark.sparkContext.addPyFile(str(tmp_path / f"{name}.py"))
    noted = lambda kind: [json.loads(x) for x in (tmp_path / kind).read_text().splitlines()] if (tmp_path / kind).exists() else []
    return name, noted, tmp_path


def test_a_run_begun_again_fetches_what_is_missing(spark, endpoint):
    name, noted, place = endpoint
    folder = f"{place}/pages"
    (place / "bad-a-2").touch()
    (place / "bad-c-1").touch()
    calls = ledger.collect_pages(spark, f"{name}:fetch", ["a", "b", "c"], folder, attempts=2, pace=0.0, at_once=2)
    assert calls == len(noted("calls")) == 7 and sorted((t, p) for t, p, _ in noted("calls")) == [("a", 1), ("a", 2), ("a", 2), ("a", 3), ("b", 1), ("c", 1), ("c", 1)]
    assert {(r.task, r.page_no): (r.status, r.message, r.calls) for r in ledger.ledger(spark, folder).collect() if r.status != "000"} == {("a", 2): ("800", "closed", 2), ("c", 1): ("800", "closed", 2)}
    assert ledger.records(spark, folder).count() == 6
    (place / "bad-a-2").unlink()
    (place / "bad-c-1").unlink()
    assert ledger.collect_pages(spark, f"{name}:fetch", ["a", "b", "c"], folder, attempts=2, pace=0.0) == 3
    assert sorted((t, p) for t, p, _ in noted("calls")[7:]) == [("a", 2), ("c", 1), ("c", 2)]
    assert ledger.collect_pages(spark, f"{name}:fetch", ["a", "b", "c"], folder, pace=0.0) == 0
    rows = ledger.records(spark, folder).collect()
    assert sorted((r.task, r.page_no, r.row_no) for r in rows) == sorted((t, p, i) for t, n in (("a", 3), ("b", 1), ("c", 2)) for p in range(1, n + 1) for i in range(2))
    assert ledger.collect_pages(spark, f"{name}:fetch", ["a", "d"], folder, pace=0.0) == 5


def test_a_batch_that_dies_shows_nothing_and_earlier_ones_stay(spark, endpoint):
    name, noted, place = endpoint
    folder = f"{place}/pages"
    (place / "crash").touch()
    with pytest.raises(Exception):
        ledger.collect_pages(spark, f"{name}:fetch", ["a", "b"], folder, pace=0.0, at_once=2)
    assert {(r.task, r.page_no) for r in ledger.ledger(spark, folder).collect()} == {("a", 1), ("b", 1)}
    (place / "crash").unlink()
    before = len(noted("calls"))
    assert ledger.collect_pages(spark, f"{name}:fetch", ["a", "b"], folder, pace=0.0, at_once=2) == 2
    assert sorted((t, p) for t, p, _ in noted("calls")[before:]) == [("a", 2), ("a", 3)]


def test_a_quota_is_not_exceeded(spark, endpoint):
    name, noted, place = endpoint
    assert ledger.collect_pages(spark, f"{name}:fetch", ["x", "y", "z"], f"{place}/pages", attempts=2, pace=0.0, quota=9) <= 9
    assert len(noted("calls")) <= 9
    ledger.collect_pages(spark, f"{name}:fetch", ["x", "y", "z"], f"{place}/pages", attempts=2, pace=0.0)
    assert len(noted("calls")) == 15 and ledger.ledger(spark, f"{place}/pages").count() == 15


def test_four_tasks_keep_one_pace(spark, endpoint):
    name, noted, place = endpoint
    ledger.collect_pages(spark, f"{name}:fetch", [f"t{i}" for i in range(12)], f"{place}/pages", pace=0.1, at_once=12, slots=4, quota=48)
    times = sorted(t for *_, t in noted("calls"))
    for i in range(len(times) - 5):
        assert times[i + 5] - times[i] > 0.1 * 5 - 0.3
    assert times[11] - times[0] > 0.75


def test_slots_of_a_pace():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(round(s, 6))
        now[0] += s

    pace = ledger.Pace(1, 4, 0.5, 0.0, lambda: now[0], sleep)
    times = []
    for skipped in (0, 0, 1, 0):
        pace.wait(skipped)
        times.append(now[0])
    assert times == [0.5, 2.5, 6.5, 8.5]
    now[0] = 100.0
    pace.wait()
    late = now[0]
    pace.wait()
    assert late == 100.0 and now[0] == 102.0
    answers = iter([{"status": "800"}, ValueError(), {"status": "000", "total_page": "2", "list": {"x": 1}}])

    def fetch(task, page):
        answer = next(answers)
        if isinstance(answer, Exception):
            raise answer
        return answer

    rows = list(ledger.fetched(fetch, "t", 1, 4, ledger.Pace(0, 1, 0.0, 0.0)))
    assert rows == [("t", 1, None, None, "000", None, 2, 3), ("t", 1, 0, '{"x": 1}', "000", None, None, None)]


COLUMNS = ["rcept_no", "corp_code", "corp_cls", "rcept_dt", "kind"]


def search(spark, name, **more):
    return searched.read_search(spark, f"{name}:search", COLUMNS, {"corp_code": "corp_code", "kind": "kind"}, {"rcept_dt": ("bgn_de", "end_de")}, pace=0.0, **more)


def test_predicates_become_parameters(spark, endpoint):
    name, noted, _ = endpoint
    found = search(spark, name, size=500, fixed={"sort": "date", "empty": ""}).filter("corp_code in ('1', '2') and rcept_dt >= '20240103' and rcept_dt <= '20240107' and corp_cls = 'Y' and kind = 'F'")
    rows = found.collect()
    assert sorted(int(r.rcept_no) for r in rows) == [i for i in range(30) if i % 3 in (1, 2) and i % 2 == 0 and 3 <= i % 9 + 1 <= 7] and {r.kind for r in rows} == {"F"}
    asked = noted("searches")
    assert sorted(a["corp_code"] for a in asked) == ["1", "2"]
    assert all({k: v for k, v in a.items() if k != "corp_code"} == {"page_count": "100", "page_no": "1", "sort": "date", "kind": "F", "bgn_de": "20240103", "end_de": "20240107"} for a in asked)


def test_pages_of_a_search_and_no_parameters(spark, endpoint):
    name, noted, _ = endpoint
    assert search(spark, name, size=7).count() == 30
    assert [(a["page_no"], a["page_count"]) for a in noted("searches")] == [(str(i), "7") for i in range(1, 6)]
    assert search(spark, name).filter("kind = 'none'").count() == 0
    assert search(spark, name).filter("corp_code = '1' and corp_code = '2'").count() == 0
    assert search(spark, name, size=0).filter("corp_code = ''").count() == 0
    assert "corp_code" not in noted("searches")[-1] and noted("searches")[-1]["page_count"] == "1"


def test_one_array_in_order_and_one_object(spark, tmp_path):
    rows = spark.range(1000).selectExpr("999 - id as n", "if(id % 3 = 0, null, concat('값 \"', id)) as `a.b`").repartition(7)
    path = str(tmp_path / "rows.json")
    single.write_array(rows, path, "n")
    read = json.loads(open(path, encoding="utf-8").read())
    assert [r["n"] for r in read] == list(range(1000)) and read[999] == {"n": 999, "a.b": None} and read[998]["a.b"] == '값 "1'
    single.write_array(rows.limit(0), path, "n")
    assert json.loads(open(path).read()) == [] and os.listdir(tmp_path) == ["rows.json"]
    single.write_object(rows.filter("n = 5"), str(tmp_path / "one.json"))
    assert json.loads(open(tmp_path / "one.json", encoding="utf-8").read())["n"] == 5


def test_a_manifest_tells_counts_by_status(spark, tmp_path):
    rows = spark.range(20).selectExpr("cast(id as string) as rcept_no", "if(id % 4 = 0, 'failed', 'ok') as status")
    single.write_manifest(rows, str(tmp_path / "m.json"), "rcept_no", about={"generated_at": "now"}, rows="results", counted="status")
    read = json.loads(open(tmp_path / "m.json").read())
    assert (read["generated_at"], read["total"], read["counts_by_status"]) == ("now", 20, {"failed": 5, "ok": 15})
    assert [r["rcept_no"] for r in read["results"]] == sorted(str(i) for i in range(20))


def test_a_failed_write_leaves_the_old_file(spark, tmp_path):
    path = str(tmp_path / "rows.json")
    single.write_array(spark.range(3), path, "id")
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        single.write_array(bad, path)
    assert json.loads(open(path).read()) == [{"id": 0}, {"id": 1}, {"id": 2}]
    time.sleep(0.2)
    assert os.listdir(tmp_path) == ["rows.json"]


def test_tags_belong_to_a_model_and_an_endpoint(spark, tmp_path):
    calls = tmp_path / "calls"

    def reply(text):
        with open(calls, "a") as f:
            f.write(text + "\n")
        return '["리스"]'

    rows = [(0, " 1 ", "x"), (1, "1", "other"), (2, "", "y"), (3, "2", "x"), (4, None, "y"), (5, "3", " ")]
    source = spark.createDataFrame([(p, r, True, t) for p, r, t in rows], "pos long, rcept_no string, kam_present boolean, kam_raw string").repartition(3)
    tagged, fresh = tagging.tag(source, reply, "m", "now", base_url="https://one.example", pos="pos")
    made = {r.rcept_no: (r.tags, r.error, r.model, r.base_url, r.cache_hit) for r in tagged.collect()}
    one = (["리스"], None, "m", "https://one.example", False)
    assert made == {"1": one, "2": one, "__norcept_3": (None, "missing_rcept_no", *one[2:]), "__norcept_5": (None, "missing_rcept_no", *one[2:])} and tagged.count() == 4
    assert calls.read_text() == "x\n" and [(r.model, r.base_url) for r in fresh.collect()] == [("m", "https://one.example")]
    same, none = tagging.tag(source, reply, "m", "now", cache=fresh, base_url="https://one.example", pos="pos")
    assert none.count() == 0 and {r.cache_hit for r in same.collect() if r.error is None} == {True} and calls.read_text() == "x\n"
    other, new = tagging.tag(source, reply, "m", "now", cache=fresh, base_url="https://two.example", pos="pos")
    assert new.count() == 1 and {r.cache_hit for r in other.collect()} == {False} and calls.read_text() == "x\nx\n"


def test_documents_of_other_filings_are_not_taken(spark):
    files = spark.createDataFrame([("1", "d/1/9_00761.xml"), ("1", "d/1/1.xml"), ("2", "d/2/2_00760.xml"), ("2", "d/2/x_00761.xml")], "rcept_no string, path string")
    assert {r.rcept_no: r.path for r in facts.choose_documents(files).collect()} == {"1": "d/1/1.xml", "2": "d/2/2_00760.xml"}


def test_years_that_are_numbers_of_other_kinds(spark):
    years = {"2024.7": 2024, "true": 1, '"2_024"': 2024, '" 2024 "': 2024, "null": None, "-3.9": -3, "false": 0}
    lines = [(json.dumps({"rcept_no": str(i)})[:-1] + f', "fiscal_year": {y}}}',) for i, y in enumerate(years)]
    bad = [('{"fiscal_year": %s}' % y,) for y in ('"2024.7"', '"2__0"', '"_2"', "[1]", "{}", '""', '"x"')]
    fine, corrupt = facts.read_facts(spark.createDataFrame(lines + bad, "value string"))
    assert {r.rcept_no: r.fiscal_year for r in fine.collect()} == {str(i): y for i, y in enumerate(years.values())} and corrupt.count() == len(bad)


def test_archives_keep_their_names_and_stay_apart(spark, tmp_path):
    rows = [("/x/00123.zip", 0, "1.xml", 1, bytearray(b"a"), None), ("/y/00123.zip", 0, "1.xml", 1, bytearray(b"b"), None)]
    archives.write_entries(spark.createDataFrame(rows, archives.ENTRY), str(tmp_path / "out"))
    read = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r.path: bytes(r.content) for r in read} == {"/x/00123.zip": b"a", "/y/00123.zip": b"b"} and len({r.archive for r in read}) == 2
    assert all(r.archive.startswith("a-00123-") for r in read)

import time

import duckdb
import pytest

from ledgerline.operators import answers
from ledgerline.plans import registry
from ledgerline.session import listed


def facts(spark, rows):
    return spark.createDataFrame([(p, r, True, t) for p, (r, t) in enumerate(rows)], "pos long, rcept_no string, kam_present boolean, kam_raw string")


def called(path):
    return path.read_text().split() if path.exists() else []


@pytest.mark.parametrize("tasks", [1, 3])
def test_a_killed_run_loses_its_last_batch_at_most(spark, tmp_path, tasks):
    calls, folder, marker = tmp_path / "calls", str(tmp_path / "answers"), tmp_path / "marker"
    marker.write_text("")

    def reply(text):
        with open(calls, "a") as f:
            f.write(text + "\n")
        if marker.exists() and len(calls.read_text().split()) >= 60:
            __import__("os")._exit(1)
        return '["리스"]'

    source = facts(spark, [(str(i), f"text{i}") for i in range(100)])
    run = lambda: answers.tag_kept(source, reply, "m", "now", folder, pos="pos", keep_every=5, at_once=2, tasks=tasks, buckets=4)
    with pytest.raises(Exception):
        run()
    kept = spark.read.json(f"{folder}/log").count()
    lost = len(called(calls)) - kept
    assert kept > 0 and lost <= tasks * (5 + 2)
    marker.unlink()
    got = run().collect()
    assert {r.rcept_no for r in got} == {str(i) for i in range(100)} and all(r.tags == ["리스"] and r.error is None for r in got)
    assert len(called(calls)) == 100 + lost and sum(r.cache_hit for r in got) == kept
    assert listed(spark, f"{folder}/log") == []
    assert all(r.cache_hit for r in run().collect()) and len(called(calls)) == 100 + lost


def test_failed_calls_are_asked_again_and_answers_stay(spark, tmp_path):
    calls, folder, marker = tmp_path / "calls", str(tmp_path / "answers"), tmp_path / "marker"
    marker.write_text("")

    def reply(text):
        with open(calls, "a") as f:
            f.write(text + "\n")
        if text == "b" and marker.exists():
            raise TimeoutError
        return '["손상", "else"]'

    source = facts(spark, [(" 1 ", "a"), ("1", "b"), ("2", "b"), ("", "a"), ("3", "a"), ("4", " ")])
    run = lambda **how: {r.rcept_no: (r.tags, r.dropped, r.error, r.cache_hit) for r in answers.tag_kept(source, reply, "m", "now", folder, pos="pos", base_url="u", tasks=2, buckets=2, **how).collect()}
    fine, missing = (["손상"], ["else"], None), (None, None, "missing_rcept_no", False)
    assert run() == {"1": (*fine, False), "3": (*fine, False), "2": (None, None, "TimeoutError", False), "__norcept_4": missing}
    assert run(retry_failed=False) == {"1": (*fine, True), "3": (*fine, True), "2": (None, None, "TimeoutError", True), "__norcept_4": missing}
    assert sorted(called(calls)) == ["a", "b"]
    marker.unlink()
    assert run() == {"1": (*fine, True), "3": (*fine, True), "2": (*fine, False), "__norcept_4": missing}
    assert sorted(called(calls)) == ["a", "b", "b"]
    state = answers.settle(spark, folder, buckets=2).collect()
    assert {(r.model, r.base_url, r.error) for r in state} == {("m", "u", None)} and len(state) == 2
    other = answers.tag_kept(source, reply, "m", "now", folder, pos="pos", base_url="v", tasks=2, buckets=2)
    assert {r.cache_hit for r in other.collect()} == {False} and sorted(called(calls)) == ["a", "a", "b", "b", "b"]


def test_empty_facts(spark, tmp_path):
    assert answers.tag_kept(facts(spark, [("1", "a")]).limit(0), str, "m", "now", str(tmp_path / "x")).collect() == []


def test_several_calls_are_under_way_at_once(spark, tmp_path):
    def reply(text):
        import threading

        threading.Event().wait(0.3)
        return "[]"

    source = spark.createDataFrame([(str(i), f"t{i}") for i in range(12)], "kam_hash string, kam_raw string")
    assert answers.ask_kept(source.limit(0), reply, str(tmp_path / "log"), "m", tasks=1) == 0
    start = time.time()
    assert answers.ask_kept(source, reply, str(tmp_path / "log"), "m", at_once=12, tasks=1) == 12
    assert time.time() - start < 12 * 0.3


def test_a_task_run_again_knows_what_it_kept(tmp_path):
    log = answers.AnswerLog(str(tmp_path / "log"), "run-000001", 2)
    for key in "abc":
        log.add(kam_hash=key, reply="x", error=None, model="m", base_url="")
    assert answers.AnswerLog(str(tmp_path / "log"), "run-000001", 2).known() == {"a", "b"}
    log.keep()
    assert answers.AnswerLog(str(tmp_path / "log"), "run-000001", 2).known() == {"a", "b", "c"}
    assert answers.AnswerLog(str(tmp_path / "log"), "run-000002", 2).known() == set()


def test_query_of_tags(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.sql(registry.ORACLE_SQL["tags_kept"])
    got = registry.QUERIES["tags_kept"](spark, sf_dir)
    own = sorted(tuple(str(r[c]) for c in want.columns) for r in got.collect())
    assert sorted(got.columns) == sorted(want.columns) and own == sorted(tuple(map(str, r)) for r in want.fetchall())

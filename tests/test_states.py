import glob
import os

import pytest

from ledgerline.sources import jsonl
from ledgerline.streaming import incremental

SCHEMA = "k string, v int"


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/bucket=*/*.parquet")}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "state")
    rows = lambda *r: spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(r)], "k string, v int, pos int")
    assert incremental.read_buckets(spark, path, SCHEMA).count() == 0
    first = incremental.upsert_buckets(spark, path, SCHEMA, rows(*[(str(i), i) for i in range(40)], (None, 1)), "k", "pos", 16)
    assert {(r.k, r.v) for r in first.collect()} == {(str(i), i) for i in range(40)}
    before = files(path)
    second = incremental.upsert_buckets(spark, path, SCHEMA, rows(("7", 70), ("7", 71), ("new", 1)), "k", "pos", 16)
    want = {(str(i), i) for i in range(40)} - {("7", 7)} | {("7", 71), ("new", 1)}
    assert {(r.k, r.v) for r in second.collect()} == want and second.count() == len(want)
    after = files(path)
    changed = {os.path.dirname(f) for f in before.keys() ^ after.keys()}
    assert 1 <= len(changed) <= 2 and all(after[f] == t for f, t in before.items() if os.path.dirname(f) not in changed)
    again = incremental.upsert_buckets(spark, path, SCHEMA, rows(("7", 71), ("new", 1)), "k", "pos", 16)
    assert {(r.k, r.v) for r in again.collect()} == want
    kept = files(path)
    incremental.upsert_buckets(spark, path, SCHEMA, rows().limit(0), "k", "pos", 16)
    assert files(path) == kept
    with pytest.raises(ValueError, match="other parameters"):
        incremental.upsert_buckets(spark, path, SCHEMA, rows(("7", 1)), "k", "pos", 8)


def test_the_last_line_of_a_folder_wins_in_any_order_of_reading(spark, tmp_path):
    line = lambda k, t: '{"rcept_no": "%s", "tags": ["%s"]}\n' % (k, t)
    for name, said in (("a", "old"), ("b", "new")):
        (tmp_path / f"{name}.jsonl").write_text("".join(line(i % 50, f"{said}{i}") for i in range(3000)) + "\n  \n")
    os.utime(tmp_path / "a.jsonl")
    told = lambda lines: {r.rcept_no: r.tags for r in jsonl.read_tag_map(lines, "at").collect()}
    want = {str(k): [f"new{2950 + k}"] for k in range(50)}
    for size in ("10k", "64m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            lines = jsonl.placed_lines(spark, str(tmp_path))
            assert told(lines) == want and told(jsonl.placed_lines(spark, str(tmp_path / "[ba].jsonl"))) == want and lines.count() == 6000
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")

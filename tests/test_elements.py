import io
import json
import os
import tracemalloc
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.sources import archives, elements, jsonl

VALUES = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(), x, max_size=4), max_leaves=8)


def read_of(text):
    data = io.BytesIO(text.encode())
    return data.read


@settings(max_examples=150, deadline=None)
@given(st.lists(VALUES, max_size=6), st.dictionaries(st.text(min_size=1), VALUES, max_size=3), st.integers(1, 40), st.booleans(), st.sampled_from([None, 1, "\t"]))
def test_elements_equal_those_of_the_whole_text(rows, others, block, plain, indent):
    others.pop("rows", None)
    items = list(others.items())
    whole = dict(items[:1] + [("rows", rows)] + items[1:])
    said = lambda x: json.dumps(x, ensure_ascii=plain, indent=indent)
    sure = lambda x: x.encode("utf-8", "replace").decode()
    assert [json.loads(v) for v in elements.split_json(read_of(sure(said(rows))), "", block)] == json.loads(sure(said(rows)))
    assert [json.loads(v) for v in elements.split_json(read_of(sure(said(whole))), "rows", block)] == json.loads(sure(said(whole)))["rows"]


@pytest.mark.parametrize("text", ["", "{}", "[1,2", "[1 2]", "[1,]", "[1]x", '{"rows": 3}', '{"rows": [1]', '{"rows": [1], "rows": [2]}', '{"a": [1]}', '{"rows": [1,"x]}', "nothing"])
@pytest.mark.parametrize("block", [1, 1000])
def test_torn_and_other_files_are_errors(text, block):
    with pytest.raises(ValueError):
        list(elements.split_json(read_of(text), "" if text.startswith("[") else "rows", block))


def test_numbers_are_not_cut_at_a_block():
    text = "[12.5e+10,-3, 123456789 ,0.25]"
    for block in range(1, len(text) + 2):
        assert list(elements.split_json(read_of(text), "", block)) == ["12.5e+10", "-3", "123456789", "0.25"]


@pytest.mark.parametrize("encoding", ["utf-8", "euc-kr"])
def test_xml_rows_at_every_block_size(encoding):
    text = f'<?xml version="1.0" encoding="{encoding}"?><result><listing>x</listing><list>\n<a>가나</a></list><list k="1">b</list ><list></list><list>torn'.encode(encoding)
    want = ["<list>\n<a>가나</a></list>", '<list k="1">b</list >', "<list></list>"]
    for block in (60, 61, 64, 70, 100, 1000):
        assert list(elements.split_xml(io.BytesIO(text).read, "list", block)) == want
    assert list(elements.split_xml(io.BytesIO(b"").read, "list")) == []


def peak(rows):
    tracemalloc.start()
    count = sum(b.num_rows for b in rows)
    try:
        return count, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_large_files_are_not_held(tmp_path):
    row = {"rcept_no": "1", "text": "가나다 " * 200}
    path = str(tmp_path / "m.json")
    with open(path, "w") as out:
        out.write('{"total": 30000, "records": [')
        for i in range(30_000):
            out.write(("," if i else "") + json.dumps(row, ensure_ascii=False))
        out.write("]}")
    assert os.path.getsize(path) > 50_000_000
    entry, raw = b"<list>" + os.urandom(100).hex().encode() * 5_000 + b"</list>", str(tmp_path / "a.zip")
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        for i in range(50):
            z.writestr(f"{i}.xml", entry)
    assert os.path.getsize(raw) > 50_000_000
    reader = lambda p, kind, of: elements.ElementReader({"path": p, "kind": kind, "of": of, "glob": "*"}).read(elements.FilePartition(f"file:{p}"))
    for rows, count in ((reader(path, "json", "records"), 30_000), (reader(raw, "entries", ""), 50)):
        got, most = peak(rows)
        assert got == count and most < 16_000_000


def test_a_folder_of_lists_and_archives(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "a.json").write_text('[{"k": 1}, {"k": "x"}]')
    (tmp_path / "in" / "b.json").write_text("﻿[]")
    (tmp_path / "in" / "c.json").write_text('[[1, 2], "t"]')
    got = [(os.path.basename(r.path), r.pos, r.value) for r in elements.json_elements(spark, str(tmp_path)).orderBy("path", "pos").collect()]
    assert got == [("a.json", 0, '{"k": 1}'), ("a.json", 1, '{"k": "x"}'), ("c.json", 0, "[1, 2]"), ("c.json", 1, '"t"')]
    assert elements.json_elements(spark, str(tmp_path), glob="*.none").count() == 0
    (tmp_path / "x.xml").write_text("<r><list>1</list><list>2</list></r>")
    assert [r.value for r in elements.xml_rows(spark, str(tmp_path), "list").orderBy("pos").collect()] == ["<list>1</list>", "<list>2</list>"]
    with zipfile.ZipFile(tmp_path / "in" / "1.zip", "w") as z:
        z.writestr("d.XML", "<list>가</list>")
        z.writestr("e.txt", "x")
    with zipfile.ZipFile(tmp_path / "none.zip", "w"):
        pass
    (tmp_path / "json.zip").write_text('{"status": "013", "message": "none"}')
    found = {(os.path.basename(r.path), r.filename, r.error) for r in archives.read_archives(spark, str(tmp_path)).collect()}
    assert found == {("1.zip", "d.XML", None), ("json.zip", "none", "json")}
    assert [r.value for r in elements.zip_rows(spark, str(tmp_path / "in"), "list").collect()] == ["<list>가</list>"]


def test_a_manifest_torn_at_its_end_is_an_error_when_read(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"records": [' + ",".join('{"rcept_no": "%d"}' % i for i in range(30_000)) + ', {"rcept')
    with pytest.raises(Exception, match="m.json"):
        jsonl.read_manifest(spark, str(tmp_path / "m.json"), "rcept_no: string").collect()

import json

import pytest

from ledgerline.operators import collection

ENDPOINT = '''
import json, os

FOLDER = "%s"


def fetch(task, page):
    with open(os.path.join(FOLDER, "calls"), "a") as f:
        f.write(task + " " + str(page) + "\\n")
    kind, keyword, first, last = task.split("|")
    if kind == "A" and page == 2 and os.path.exists(os.path.join(FOLDER, "closed")):
        return {"status": "800", "message": "closed"}
    if kind == "A" and first > "20240401":
        return {"status": "013"}
    rows = [
        {"rcept_no": f"{first}{page}", "rcept_dt": last, "report_nm": keyword + " (2024.12)", "corp_code": "1", "flr_nm": None},
        {"rcept_no": "same", "rcept_dt": first, "report_nm": "연결" + keyword if kind == "F" else keyword, "rm": kind + str(page)},
        {"rcept_no": f"c{first}{page}", "rcept_dt": first, "report_nm": "[기재정정]" + keyword},
        {"rcept_no": f"o{first}{page}", "rcept_dt": first, "report_nm": "분기보고서"},
    ]
    return {"status": "000", "total_page": 2, "list": rows}
'''


def plain(pages):
    """The collection by its rules, page by page in the tasks' order."""
    found = {}
    for kind, keyword, first, last, page in pages:
        for no, day, name in ((f"{first}{page}", last, keyword + " (2024.12)"), ("same", first, "연결" + keyword if kind == "F" else keyword)):
            found[no] = (no, day, name, next((c for c in ("연결감사보고서", "감사보고서", "사업보고서") if c in name), "기타"))
    return sorted(found.values(), key=lambda r: (r[1], r[0]))


def test_from_targets_to_manifest_and_again(spark, tmp_path):
    name = "listing_endpoint"
    (tmp_path / f"{name}.py").write_text(ENDPOINT % tmp_path)
    spark.sparkContext.addPyFile(str(tmp_path / f"{name}.py"))
    folder = str(tmp_path / "run")
    (tmp_path / "closed").touch()
    go = lambda end="20240630": collection.run(spark, f"{name}:fetch", "20240101", end, folder, "now", "https://filings.example/%s", exclude_corrections=True, attempts=2, pace=0.0)
    windows = [("20240101", "20240331"), ("20240401", "20240630")]
    pages = [("F", "감사보고서", a, b, p) for a, b in windows for p in (1, 2)] + [("A", "사업보고서", a, b, p) for a, b in windows[:1] for p in (1, 2)]
    told = lambda df: [(r.rcept_no, r.rcept_dt, r.report_name, r.category) for r in df.orderBy("rcept_dt", "rcept_no").collect()]
    # the second A window begins at 20240401, so it has rows, too
    pages += [("A", "사업보고서", *windows[1], p) for p in (1, 2)]
    assert told(go()) == plain([p for p in pages if not (p[0] == "A" and p[4] == 2)])
    read = json.loads(open(f"{folder}/manifest.json", encoding="utf-8").read())
    assert [(f["pblntf_ty"], f["bgn_de"], f["page_no"], f["message"]) for f in read["failed_pages"]] == [("A", "20240101", 2, "closed"), ("A", "20240401", 2, "closed")]
    before = len((tmp_path / "calls").read_text().splitlines())
    (tmp_path / "closed").unlink()
    assert told(go()) == plain(pages)
    assert len((tmp_path / "calls").read_text().splitlines()) == before + 2
    read = json.loads(open(f"{folder}/manifest.json", encoding="utf-8").read())
    assert read["failed_pages"] == [] and read["generated_at"] == "now" and read["windows"] == [list(w) for w in windows]
    assert [(r["rcept_no"], r["rcept_dt"], r["report_name"], r["category"]) for r in read["records"]] == plain(pages)
    assert read["total"] == len(plain(pages)) and sum(read["counts_by_category"].values()) == read["total"]
    go()
    assert len((tmp_path / "calls").read_text().splitlines()) == before + 2
    with pytest.raises(ValueError, match="other parameters"):
        go("20240930")

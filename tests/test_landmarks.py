"""Reports with several landmarks, held against the plain rules: find each mark, cut up to the nearest next one."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerline import dictionaries as D
from ledgerline.functions import text as T
from ledgerline.operators import facts

WORDS = [*D.OPINION_HEADERS, *D.SECTION_LANDMARKS, *D.GOING_CONCERN_HEADERS, "의견", "감사의견을", "ㆍ감사의견", "공정하게 표시하고 있습니다.", "제외하고는", "대한회계법인", "민 국 회 계 법 인", "가나 감사반", "가회계법인", "끝.", "abc", "﷐", "﷑x", "$1"]


def find(text, mark, start=0):
    while (at := text.find(mark, start)) >= 0:
        if text[at + len(mark) : at + len(mark) + 1] in ("", " "):
            return at
        start = at + 1
    return -1


def stop(text, start, but=None):
    return min([at for m in D.SECTION_LANDMARKS if m != but and (at := find(text, m, start)) >= 0], default=len(text))


def plain(text):
    def section(header):
        at = find(text, header)
        start = at + len(header)
        return "" if at < 0 else text[start : min(stop(text, start, header), start + 6000)].strip()

    headers = [(at, h) for h in D.OPINION_HEADERS if (at := find(text, h)) >= 0]
    at, header = min(headers, default=(None, ""))
    opinion = "" if at is None else text[at : min(stop(text, at + len(header)), at + 1200)].strip()
    doubt = next((text[at + len(h) : at + len(h) + 400].strip() for h in D.GOING_CONCERN_HEADERS if (at := find(text, h)) >= 0), None)
    signed = re.findall(D.SIGNATURE_PATTERN.removeprefix("(?U)"), text)
    return opinion, doubt, section(D.KEY_MATTERS), section(D.EMPHASIS), signed[-1] if signed else ""


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    made = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 25))) for _ in range(600)]
    long = ["핵심감사사항 " + "긴 문장 " * 3000 + "기타사항 끝", "감사의견 " + "말 " * 900 + "강조사항 x", "강조사항", "계속기업 관련 중대한 불확실성 " + "나 " * 500, "강조사항 가 강조사항 나 기타사항 다", "머리 " * 5000 + "한정의견 끝"]
    return [*made, *long, "", "핵심감사사항 기타사항", *(m for m in WORDS), *(" ".join(t) for t in zip(WORDS, WORDS[1:]))]


def test_sections_equal_the_plain_rules(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, full_text string").repartition(4)
    text = F.col("full_text")
    rows = facts.with_landmarks(docs).select("i", facts.opinion_paragraph(text), facts.going_concern(text), facts.section(text, "kam"), facts.section(text, "emphasis"), T.last_match_in_runs(text, D.SIGNATURE_PATTERN, D.SIGNATURE_CHARACTERS, D.SIGNATURE_ENDING)).collect()
    for i, *got in rows:
        assert tuple(got) == plain(texts[i]), texts[i]
    assert len(rows) == len(texts)


def test_raised_doubt_without_a_header(spark):
    said = "가 " * 60 + "계속기업으로서의 존속능력에 대하여 유의적인 의문을 제기할 수 있는 불확실성 " + "나 " * 300
    (row,) = facts.with_landmarks(spark.createDataFrame([(said,)], "full_text string")).select(facts.going_concern(F.col("full_text")).alias("x")).collect()
    at = said.index("계속기업")
    raised = said[at : said.index("제기") + 2]
    assert row.x == said[at - 80 : at + len(raised) + 250].strip()


def test_one_pattern_and_no_locate_in_the_plan(spark):
    docs = spark.createDataFrame([("1", b"x")], "rcept_no string, content binary")
    plan = facts.parse_reports(docs)._jdf.queryExecution().executedPlan().toString()
    assert "locate(" not in plan and plan.count("핵심감사사항\\E") == 1


def test_marks_inside_one_another_are_refused():
    with pytest.raises(ValueError, match="inside"):
        T.Landmarks(["a", "b a"])
    assert T.Landmarks(["감사의견", "감사의견근거"]).marks == ("감사의견", "감사의견근거")


def test_null_and_empty_reports(spark):
    docs = spark.createDataFrame([("1", None), ("2", b"")], "rcept_no string, content binary")
    assert {(r.audit_opinion, r.kam_raw, r.going_concern) for r in facts.parse_reports(docs).collect()} == {("unknown", "", False)}

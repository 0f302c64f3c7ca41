import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions.automaton import PIECE, Automaton
from ledgerline.functions.wordtable import WordTable
from ledgerline.operators import dictionary, lookup

LETTERS = st.text("abcé수익", min_size=1, max_size=5)


def places(text, term):
    return [m.start() for m in re.finditer(f"(?={re.escape(term)})", text)]


@settings(max_examples=300, deadline=None)
@given(st.sets(LETTERS, max_size=12), st.lists(st.text("abcé수익 ", max_size=60), max_size=5))
def test_automaton_finds_every_occurrence(terms, texts):
    terms = sorted(terms)
    doc, start, term = Automaton(terms).starts([t.encode() for t in texts])
    got = sorted((d, len(texts[d].encode()[:s].decode()), terms[t]) for d, s, t in zip(doc.tolist(), start.tolist(), term.tolist()))
    assert got == sorted((d, at, t) for d, text in enumerate(texts) for t in terms for at in places(text, t))


def test_long_texts_are_searched_in_pieces():
    rng = random.Random(5)
    text = "".join(rng.choice("ab ") for _ in range(5 * PIECE + 17))
    terms = ["a" * 3, "ab", "b a b", text[PIECE - 3 : PIECE + 9], text[: 2 * PIECE // 3]]
    doc, start, term = Automaton(terms).starts([b"", text.encode(), b"ab"])
    for i, t in enumerate(terms):
        assert sorted(start[(term == i) & (doc == 1)].tolist()) == places(text, t)
    assert start[doc == 2].tolist() == [0]


TEXTS = [(1, "리스크 관리와 리스 계약"), (2, "리스크뿐"), (3, None), (4, ""), (5, "보증금 보증 수익인식 수익인식"), (6, "abcd abc ab"), (7, "abcabcd" * 40_000)]
TERMS = [(3, "lease", "리스"), (1, "revenue", "수익인식"), (2, "warranty", "보증"), (4, "abc", "abc"), (4, "also abc", "abc"), (5, "bc", "bc"), (6, "none", ""), (7, "null", None), (8, "risk", "리스크")]
LONGER = [("리스", "리스크"), ("보증", "보증금"), ("abc", "abcd"), ("ab", "abc"), ("bc", ""), (None, "x")]


def brute(text, longer):
    out = []
    for pos, name, term in sorted((t for t in TERMS if t[2]), key=lambda t: (t[0], t[1])):
        void = {at for t, x in longer if t == term and x for at in places(text or "", x)}
        found = [at for at in places(text or "", term) if at not in void]
        if found:
            out.append((pos, name, len(found), found[0] + 1))
    return out


@pytest.mark.parametrize("most", [1 << 20, 7])
@pytest.mark.parametrize("longer", [[], LONGER])
def test_terms_in(spark, most, longer):
    docs = spark.createDataFrame([(i, t, "x") for i, t in TEXTS], "doc_id long, text string, terms string")
    terms = spark.createDataFrame(TERMS, "pos long, name string, term string")
    ruled = spark.createDataFrame(longer, "term string, longer string") if longer else None
    found = {r.doc_id: sorted(tuple(x) for x in r.terms) for r in dictionary.terms_in(docs, terms, "doc_id", longer=ruled, most=most).collect()}
    assert found == {i: sorted(brute(t, longer)) for i, t in TEXTS}
    assert [x.pos for x in dictionary.terms_in(docs, terms, "doc_id", most=most).filter("doc_id = 5").first().terms] == [1, 2]


def test_extensions_and_empty_tables(spark):
    terms = spark.createDataFrame([(0, "n", t) for t in ("a", "ab", "abc", "b", "ab", "")], "pos long, name string, term string")
    assert sorted(tuple(r) for r in dictionary.extensions(terms).collect()) == [("a", "ab"), ("a", "abc"), ("ab", "abc")]
    docs = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert [x.name for r in dictionary.terms_in(docs, terms.limit(0), "doc_id").collect() for x in r.terms] == []
    assert dictionary.terms_in(docs.limit(0), terms, "doc_id").collect() == []
    found = dictionary.terms_in(docs, terms, "doc_id", longer=dictionary.extensions(terms)).first().terms
    assert [(x.n, x.first) for x in found] == [(1, 1), (1, 2)]


def test_a_dictionary_needs_one_scan_and_no_join(spark, sf_dir):
    from ledgerline.plans.lookups import _terms

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = dictionary.terms_in(docs, _terms(docs), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan") == 1


NAMES = [(1, "Alpha"), (2, "alpha"), (3, "Alphabet"), (4, "Beta Alpha"), (5, None), (6, ""), (7, "삼성전자"), (8, "삼성"), (9, "x"), (10, "Gamma Ray"), (11, "gam")]


def resolved(query, most):
    wanted = query.strip().lower() if query is not None else ""
    rank = lambda name: 0 if name == wanted else 1 if name.startswith(wanted) else 2 if wanted in name else None
    hits = sorted((rank(n.lower()), i) for i, n in NAMES if n is not None and wanted and rank(n.lower()) is not None)
    own = [h for h in hits if h[0] == 0] or hits
    return "unique" if len(own) == 1 else "ambiguous" if own else "not_found", own[0][1] if len(own) == 1 else None, len(own), [i for _, i in own[:most]], max(0, len(own) - most)


@pytest.mark.parametrize("most", [20, 2])
def test_table_of_queries(spark, most):
    queries = [" ALPHA ", "alph", "a", "am", "삼성", "삼성전", "전자", "x", "xx", "", None, "  ", "ray", "gamma  ray", "zzz", "alpha"]
    rows = lookup.resolve_table(spark.createDataFrame(NAMES, "code long, name string"), spark.createDataFrame([(q,) for q in queries * 2], "query string"), "name", "code", "code", most).collect()
    assert {r.query: (r.status, r.code, r.n_candidates, r.candidates, r.more) for r in rows} == {q: resolved(q, most) for q in queries} and len(rows) == len(set(queries))


def test_no_queries_and_no_names(spark):
    names, queries = spark.createDataFrame(NAMES, "code long, name string"), spark.createDataFrame([("alpha",)], "query string")
    assert lookup.resolve_table(names, queries.limit(0), "name", "code", "code").collect() == []
    assert [r.status for r in lookup.resolve_table(names.limit(0), queries, "name", "code", "code").collect()] == ["not_found"]


def test_names_meet_by_equality_alone(spark, sf_dir):
    from ledgerline.plans.lookups import names_resolved

    plan = names_resolved(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_grams(spark):
    rows = spark.createDataFrame([("abab",), ("a",), ("",), (None,)], "x string").select(lookup.grams(F.col("x"), 2).alias("g")).collect()
    assert [sorted(r.g) for r in rows] == [["ab", "ba"], [], [], []]


def test_automaton_size_is_bounded():
    terms = [f"{i:08x}" for i in np.random.default_rng(1).integers(0, 1 << 32, 4000)]
    made = Automaton(sorted(set(terms)))
    assert made.nbytes <= (1 + sum(map(len, set(terms)))) * 1024


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abé수", min_size=1, max_size=20), max_size=12), st.lists(st.text("abé수 ", max_size=90), max_size=5))
def test_word_table_finds_every_occurrence(terms, texts):
    terms = sorted(terms)
    texts = [*texts, "".join(terms)]
    doc, start, term = WordTable(terms).starts([t.encode() for t in texts])
    got = sorted((d, len(texts[d].encode()[:s].decode()), terms[t]) for d, s, t in zip(doc.tolist(), start.tolist(), term.tolist()))
    assert got == sorted((d, at, t) for d, text in enumerate(texts) for t in terms for at in places(text, t))


def test_a_large_dictionary_needs_one_scan_too(spark, tmp_path):
    """More terms than an automaton takes: texts are read once, whatever the number of terms."""
    words = [f"wörter{i:06d}" for i in range(9000)]
    spark.createDataFrame([(i, f"{words[i]} x{words[-1 - i]}x") for i in range(60)] + [(99, None)], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = dictionary.terms_in(docs, spark.createDataFrame([(i, "w", w) for i, w in enumerate(words)], "pos long, name string, term string"), "doc_id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Exchange" not in plan
    assert {r.doc_id: [(x.pos, x.n, x.first) for x in r.terms] for r in found.collect()} == {i: [(i, 1, 1), (8999 - i, 1, 15)] for i in range(60)} | {99: []}


def test_nothing_that_grows_is_broadcast_and_a_query_meets_its_own_names_alone(spark, sf_dir):
    from ledgerline.plans.lookups import names_resolved

    plan = names_resolved(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    names = spark.createDataFrame([(f"customer#{i:09d}",) for i in range(3000)], "name string")
    asked = names.select(F.col("name").alias("wanted"))
    met = lookup.matching_names(names, asked)
    assert met.count() == 3000
    # A filter after the join would hide what the join makes: the join itself has as many rows as there are matches.
    joins = []
    todo = [met._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if "AdaptiveSparkPlan" in node.nodeName():
            node.execute().count()
            todo.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if "Join" in node.nodeName():
            joins.append(node.metrics().apply("numOutputRows").value())
    assert joins and max(joins) == 3000


@pytest.mark.parametrize("most", [20, 2])
def test_long_queries_and_names(spark, most):
    """Queries of 31 to 70 characters, alike but for a few; names alike over more than a run."""
    names = [(i, "A" * 40 + f" common part of all names {i % 7} " + "z" * (i % 3) + f"end{i:02d}") for i in range(40)] + [(40, None), (41, "a" * 32), (42, "a" * 31)]
    queries = ["a" * 30, "a" * 31, "a" * 32, "A" * 33, "a" * 41, *(n[a : a + k] for _, n in names[:9] for a, k in ((0, 64), (38, 34), (9, 61), (0, 99), (20, 32))), names[3][1] + "x", " END07 "]
    rows = lookup.resolve_table(spark.createDataFrame(names, "code long, name string"), spark.createDataFrame([(q,) for q in queries], "query string"), "name", "code", "code", most).collect()

    def want(query):
        q = query.strip().lower()
        hits = sorted((0 if n.lower() == q else 1 if n.lower().startswith(q) else 2, i) for i, n in names if n is not None and q in n.lower())
        own = [h for h in hits if h[0] == 0] or hits
        return "unique" if len(own) == 1 else "ambiguous" if own else "not_found", own[0][1] if len(own) == 1 else None, len(own), [i for _, i in own[:most]], max(0, len(own) - most)

    assert {r.query: (r.status, r.code, r.n_candidates, r.candidates, r.more) for r in rows} == {q: want(q) for q in queries}

import re
from collections import defaultdict
from itertools import permutations

import pytest

from ledgerline.llm import interaction as I
from ledgerline.llm.queries import op13_filter_interaction_audit


def failures(docs):
    """Letters that each (doc_id, text, source) fails, by plain rules."""
    first = {}
    for doc, text, _ in docs:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    out = []
    for doc, text, _ in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": re.search(r"[#$%&*|]", t) is not None, "E": doc is not None and first[t] < doc,
        }
        out.append({k for k, v in fails.items() if v})
    return out


def brute(docs, labels):
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, x in labels if x == 1}
    parts = defaultdict(list)
    for (doc, _, source), fails in zip(docs, failures(docs)):
        parts[source or ""].append((doc, fails))
    rows = {}
    for part, own in parts.items():
        total = defaultdict(int)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x for _, x in own) - len(gone), sum(x == {f} for _, x in own),
                    sum(d in good for d, _ in gone if d is not None), sum(d in toxic for d, _ in gone if d is not None),
                ]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in rows.items()}


def told(df):
    rows = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in df.collect()}
    return rows


def test_query_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert told(op13_filter_interaction_audit(spark, sf_dir)) == brute(docs, labels)


LONG = " ".join(f"w{i}" for i in range(250))
EDGES = [
    (4, None, "a"), (2, "", "a"), (9, "", None), (None, "", "a"), (None, "", "a"), (3, LONG, "b"), (3, LONG, "b"), (3, LONG, "a"), (8, LONG, "b"), (8, LONG, "b"),
    (None, LONG, None), (1, LONG + " X" * 3, "b"), (11, "# " * 300, "a"), (12, "A b\x0bc\x1cd\xa0e", "c"), (13, "été " * 400 + "Z", ""), (-5, "same", "a"), (6, "same", "b"), (7, "same", "c"),
]
LABELS = [(3, 1, 0), (3, 0, 1), (8, 1, None), (None, 1, 1), (999, 1, 1), (9, None, 1), (6, 0, 1), (6, 0, 1), (2, 1, 1)]


@pytest.mark.parametrize(("parts", "held"), [(1, 1 << 20), (7, 1 << 20), (3, 1)])
def test_edges(spark, parts, held, monkeypatch):
    docs = spark.createDataFrame([(*d, 1, 2, "x") for d in EDGES], "doc_id long, text string, source string, part int, `a.b` int, mask string").repartition(parts)
    labels = spark.createDataFrame([(*x, 5) for x in LABELS], "doc_id long, quality int, toxic int, text int")
    monkeypatch.setattr(I.masks, "__defaults__", (*I.masks.__defaults__[:-1], held))
    assert told(I.audit(docs, labels)) == brute(EDGES, LABELS)
    repeated = sorted(r.doc_id for r in I.repeated_ids(docs).collect())
    assert repeated == sorted(d for (d, *_), f in zip(EDGES, failures(EDGES)) if "E" in f)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert I.audit(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "a", "s")], docs.schema)
    assert len(I.audit(one, labels).collect()) == 600


def test_chains_keep_texts_of_one_hash_apart():
    chain = I.Chain(16)
    rows = [("x", 5), ("y", 4), ("x", 3), ("y", 9), ("x", 3), ("z", 1)]
    late = [r for text, doc in rows for r in chain.add(text.encode(), doc, 0, {"p": 1})]
    assert late == [(5, "p", 16, 1), (9, "p", 16, 1)]
    assert [(e[0], e[1], e[3]) for e in chain.entries] == [(b"x", 3, {"p": 2}), (b"y", 4, {"p": 1}), (b"z", 1, {"p": 1})]


def test_a_text_with_very_many_copies_is_routed_once_a_task(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "if(id % 3 = 0, repeat('copy ', 400), concat('text ', id)) as text", "'s' as source").repartition(4)
    found = I.masks(docs).selectExpr("mask >= 16 as late", "n").groupBy("late").sum("n").collect()
    assert {r.late: r["sum(n)"] for r in found} == {True: 6666, False: 13334}
    assert sorted(r.doc_id for r in I.repeated_ids(docs).collect()) == list(range(3, 20_000, 3))


def test_other_filters(spark):
    docs = spark.createDataFrame([(1, "one two", "s"), (2, "one", "s"), (3, "one", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = told(I.audit(docs, labels, {"S": lambda text, words, chars: len(words) < 2}, "R"))
    assert rows == {("s", "SR", 1): (1, 2, 0, 1, 0, 0, 3), ("s", "SR", 2): (1, 0, 1, 0, 0, 0, 1), ("s", "RS", 1): (2, 1, 0, 0, 0, 0, 1), ("s", "RS", 2): (1, 1, 1, 1, 0, 0, 3)}
    with pytest.raises(ValueError, match="letter of its own"):
        I.audit(docs, labels, {"R": len}, "R")

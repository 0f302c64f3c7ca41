"""Operators that keep rows keep columns of any name."""

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import language, minhash, pii, quality, secrets
from ledgerline.llm.columns import by_place

ODD = ["a.b", "c`d", "`", "__hash", "row", "digest", "x y", "__at0", "id", "label", "ü", "masked.text"]


@pytest.fixture(scope="module")
def odd(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id % 5 = 0 or doc_id < 40")
    some = docs.unionByName(spark.createDataFrame([(None, None, None, None, None), (77, "", "en", None, 0), (7, "password: hunter22secret4 x", "en", "s", 27)], docs.schema))
    return some.select("*", *(F.lit(i).alias(name) for i, name in enumerate(ODD)))


def test_names_by_place(odd):
    got = by_place(odd, "doc_id", "text")
    assert got.columns[:2] == ["doc_id", "text"] and len(set(c.lower() for c in got.columns)) == len(odd.columns) and not any(set(".` ") & set(c) for c in got.columns)
    twice = by_place(odd.select("doc_id", "text", F.lit(1).alias("TEXT"), F.lit(2).alias("text")), "doc_id", "text")
    assert twice.columns.count("text") == 1 and len(twice.select("doc_id", "text").head()) == 2


@pytest.mark.parametrize("stage", ["keep_identified", "keep_quality", "drop_near_duplicates", "redact", "mask"])
def test_columns_of_any_name_stay(spark, sf_dir, odd, stage):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    apply = {
        "keep_identified": language.keep_identified, "keep_quality": lambda d: quality.keep_quality(d, labels), "drop_near_duplicates": minhash.drop_near_duplicates,
        "redact": secrets.redact, "mask": lambda d: pii.mask(d, b"key"),
    }[stage]
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    got = apply(odd)
    assert got.columns == odd.columns and dict(got.dtypes) == dict(odd.dtypes)
    rows, want = got.collect(), apply(odd.select(plain)).collect()
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted(key(r[: len(plain)]) for r in rows) == sorted(key(r) for r in want) and len(rows) > 20
    assert all(tuple(r[len(plain) :]) == tuple(range(len(ODD))) for r in rows)

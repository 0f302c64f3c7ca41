import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import token_files as T
from ledgerline.llm.queries import op12_token_files, vocabulary

JSON = vocabulary("word_bpe_49k.json")


@cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


def whole(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, T.END_ID]


@cache
def encoder():
    return T.Encoder(JSON, cached=3)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n\x0b\x1c\x85\xa0'sSreİΣσ̈́<|endoftext|>"))))
def test_encoder_equals_the_library(text):
    text += "<|endoftext|>" if len(text) % 3 == 0 else ""
    encode = encoder()
    assert np.frombuffer(encode(text), f"<u{encode.width}").tolist() == whole(text)[:-1]


@pytest.mark.parametrize("cached", [1, 3, T.CACHED])
def test_columns_of_texts_equal_the_library(cached):
    texts = pa.array(["cut", " a b\n", None, "", "  ", "İstanbul <|endoftext|> e\u0301", "a b a\xa0b " * 30, "x" * 300, "\tlast\x1c"]).slice(1)
    made = T.Encoder(JSON, cached=cached).each(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in made] == [whole(t)[:-1] for t in texts.to_pylist()]
    assert T.Encoder(JSON).each(texts.slice(1, 3)) == [b""] * 3


def test_tasks_of_a_worker_share_the_words_they_met(spark):
    def known(batches):
        encode = T.encoder(JSON)
        before = len(encode._known)
        for batch in batches:
            encode.each(pa.array([f"word{x}" for x in batch.column(0).to_pylist()]))
        yield pa.RecordBatch.from_arrays([pa.array([before])], ["before"])

    rows = spark.range(0, 64, 1, 64).mapInArrow(known, "before long").collect()
    assert sum(r.before > 1 for r in rows) > 30


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-(1 << 63), (1 << 63) - 1)), st.integers(0, 3000))
def test_hash_is_minimal_and_perfect(some, more):
    keys = np.array(sorted(some | set(range(more))), np.int64)
    assert sorted(T.PerfectHash.of(keys)(keys).tolist()) == list(range(len(keys)))


def test_hash_takes_few_bits_a_key():
    keys = np.arange(0, 10**6, 7)
    made = T.PerfectHash.of(keys)
    assert 64 * len(made.words) < 4 * len(keys) and len(made.sizes) < 30


def test_query_equals_the_library_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    rows = {r.doc_id: r for r in op12_token_files(spark, sf_dir).collect()}
    start = 0
    assert len(rows) == len(docs)
    for d in docs:
        ids, r = whole(d.text), rows[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


@pytest.fixture
def written(spark, tmp_path):
    rows = [(5, "five five"), (None, "no id"), (7, ""), (7, None), (-3, "x" * 3000), (7, "seven"), (9, "same"), (9, "same"), (2**62, "large"), (None, None)]
    docs = spark.createDataFrame([(i, t, "a", "b", 1, 2) for i, t in rows], "doc_id long, text string, `ids` string, `by_text` string, `Start` int, `a.b` int").repartition(3)
    folder = f"file:{tmp_path}/ids"
    return rows, folder, T.write_ids(docs, folder, JSON, shard_ids=4)


def test_edges_by_scan_and_by_key(spark, written):
    rows, folder, shards = written
    assert shards.count() > 2
    read = sorted(T.read_ids(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in read] == [-3, 5, 7, 7, 7, 9, 9, 2**62, None, None]
    assert [r.start for r in read] == np.cumsum([0, *[r.n_tokens for r in read]]).tolist()[:-1]
    told = lambda doc, ids: (str(doc), tuple(ids))
    assert sorted(told(r.doc_id, r.ids) for r in read) == sorted(told(i, whole(t)) for i, t in rows)
    digests = {(r.start, r.n_tokens, r.ids_crc32) for r in T.read_ids(spark, folder, digests=True).collect()}
    assert digests == {(r.start, r.n_tokens, crc(r.ids)) for r in read}
    keys = spark.createDataFrame([(7,), (8,), (None,), (2**62,), (-(10**18),), (9,)], "doc_id long")
    found = sorted(T.lookup(keys, folder).collect(), key=lambda r: r.start)
    assert [tuple(r) for r in found] == [tuple(r) for r in read if r.doc_id in (7, 9, 2**62)]


def test_all_keys_by_lookup(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    T.write_ids(docs, str(tmp_path / "ids"), JSON, shard_ids=20_000)
    found = {tuple(r[:3]): r.ids for r in T.lookup(docs.select("doc_id"), str(tmp_path / "ids")).collect()}
    assert found == {tuple(r[:3]): r.ids for r in T.read_ids(spark, str(tmp_path / "ids")).collect()}
    absent = spark.range(10**9, 10**9 + 5000).toDF("doc_id")
    assert T.lookup(absent, str(tmp_path / "ids")).count() == 0


def test_rows_of_one_id_are_dealt_to_many_tasks(spark, tmp_path):
    docs = spark.range(4000).selectExpr("7L as doc_id", "'same text' as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = T.write_ids(docs, str(tmp_path / "ids"), JSON).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(shards) > 1 and sum(s.documents for s in shards) == 4000
    assert T.lookup(spark.createDataFrame([(7,)], "doc_id long"), str(tmp_path / "ids")).count() == 4000


def test_empty_table_and_files_left_by_a_lost_task(spark, written, tmp_path):
    none = T.write_ids(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "none"), JSON)
    assert none.count() == 0 and T.read_ids(spark, str(tmp_path / "none")).count() == 0
    assert T.lookup(spark.range(3).toDF("doc_id"), str(tmp_path / "none")).count() == 0
    rows, folder, _ = written
    for end in ("ids", "index"):
        with open(folder.removeprefix("file:") + f"/shards/000000-deadbeef-000000.{end}", "wb") as f:
            f.write(b"cut off")
    assert T.read_ids(spark, folder).count() == len(rows)


def test_a_damaged_index_is_told(spark, written):
    import glob

    _, folder, _ = written
    for path in glob.glob(folder.removeprefix("file:") + "/shards/*.index"):
        raw = bytearray(open(path, "rb").read())
        raw[0] ^= 1
        open(path, "wb").write(raw)
    with pytest.raises(Exception, match="not an index"):
        T.read_ids(spark, folder).collect()

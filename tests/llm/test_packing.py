import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pytest

from ledgerline.llm.bpe import Encoder
from ledgerline.llm.packing import pack
from ledgerline.llm.queries import op10_packing, vocabulary

JSON, RANKS = vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken")


@cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


def whole(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, texts, size=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids, at = whole(text), 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_sequence)


def test_encoder_equals_the_library():
    texts = [None, "", "it's 's '  I'll've", "a<|endoftext|>b", " \n\t x\r\n", "\x1c\x85\xa0z", "été 中文 ٣4 ''s", "x" * 5000, "don'tt 're"]
    ids, offsets = Encoder(JSON, RANKS, cached=5)(texts)
    assert [ids[a:b].tolist() + [0] for a, b in zip(offsets, offsets[1:])] == [whole(t) for t in texts]


def test_query_packs_every_id_once(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sequences = check(op10_packing(spark, sf_dir).collect(), texts)
    assert sequences == -(-sum(len(whole(t)) for t in texts.values()) // 1024)


@pytest.mark.parametrize("parts", [1, 5])
def test_edge_cases(spark, parts):
    texts = {1: None, 2: "", 3: "word " * 9000, 4: "same text", 5: "same text", 6: " "}
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in texts.items()], "doc_id long, text string, start long, sequence_id string").repartition(parts)
    check(pack(docs, JSON, RANKS).collect(), texts)
    assert pack(docs.limit(0), JSON, RANKS).count() == 0


def test_null_ids_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "a b c"), (1, "a"), (1, "a")], "doc_id long, text string")
    rows = pack(docs, JSON, RANKS).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 4), (1, 2), (1, 2)]

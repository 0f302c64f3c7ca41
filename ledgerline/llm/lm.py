"""Language-model scores from a log-frequency Bloom filter of word and word-pair counts.

Counts of single words and of pairs of neighbours come from all training documents. A count is quantised to a level
(1 + floor(log2 count)); the filter holds (n-gram, 1) ... (n-gram, level), and a level is read back by probing until a
probe fails. A text's score adds log10(PAIR * pair / first + (1 - PAIR) * word), with the counts that the levels stand
for; pair / first is at most 1.

The filter is made in slices, one for each shard of hashed n-grams, each sized for all its shard's n-grams: it grows with
the text, and a slice is only held by the task of its shard, which reads the levels back. No n-gram is left out. The
base score, ``n_known`` and ``train_tokens`` use exact counts and no filter.

Each task cuts its documents into blocks of bounded text. A block's distinct words and pairs go to the shards that they
belong to (a row for each such shard, so that rows never outnumber the keys), the shards send the words' exact counts and
all levels back in the order of the keys, and the block meets its documents again. Documents must come in the same order
whenever they are read (a scan or a checkpoint does); a block whose keys have another sum raises an error.

Defined results: a null text is empty: its end token alone; a null id counts as a training document; equal rows are
scored once each; no training tokens: the base score is that of V = 0 (log10 of 1 for each token); an empty table gives
no rows; other columns are not read. Ids are integers (other kinds are cast to long).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .segments import code_points, hashes, mix, slices, words

BLOCK_CHARS = 12_000_000
CHARS_AT_ONCE = 1_000_000
#: Distinct pairs in a shard, about; shards at least.
SHARD_CHARS, FEWEST_SHARDS = 12_000_000, 8
BITS_PER_ENTRY, PROBES = 8, 4
PAIR = 0.6
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def is_training(doc_id) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1


def tokens(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words in order, A-Z in lower case, each text followed by the end token."""
    points, offsets = code_points(texts)
    upper = (points >= 65) & (points <= 90)
    points = np.where(upper, points + np.uint32(32), points)
    starts, ends, n_words = words(points, offsets)
    bounds = np.concatenate([[0], np.cumsum(n_words + 1)])
    out = np.full(bounds[-1], END, np.uint64)
    inner = np.ones(len(out), bool)
    inner[bounds[1:] - 1] = False
    out[inner] = hashes(points, starts, ends)
    return out, bounds


def firsts(token: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """What precedes each token in its text; the start mark before the first."""
    before = np.concatenate([[START], token[:-1]]) if len(token) else token
    before[bounds[:-1]] = START
    return before


def pair_hash(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(3) + mix(token + _GOLDEN))


def levels(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1]


def level_counts(level: np.ndarray) -> np.ndarray:
    """The count that a level stands for: 1 for the first, else the middle of its range."""
    return np.where(level > 1, 1.5 * 2.0 ** (level - 1) - 0.5, level.astype(np.float64))


def _bits(keys: np.ndarray, level: np.ndarray | int, size: int) -> list[np.ndarray]:
    a = mix(keys ^ mix(np.asarray(level, np.uint64) * _GOLDEN))
    b = mix(a) | np.uint64(1)
    return [(a + np.uint64(i) * b) % np.uint64(size) for i in range(PROBES)]


def make_slice(keys: np.ndarray, counts: np.ndarray, most_bits: int | None = None) -> bytes:
    """A slice of all n-grams; with ``most_bits``, of those with the smallest least count that fits (not in ``score``)."""
    level = levels(counts)
    least = 1
    while most_bits is not None and level[counts >= least].sum() * BITS_PER_ENTRY > most_bits:
        least += 1
    keys, level = keys[counts >= least], level[counts >= least]
    size = max(64, int(level.sum()) * BITS_PER_ENTRY // 8 * 8)
    table = np.zeros(size, bool)
    for step in range(1, int(level.max(initial=0)) + 1):
        for at in _bits(keys[level >= step], step, size):
            table[at] = True
    return np.packbits(table, bitorder="little").tobytes()


class Filter:
    """Slices, and the levels read back from them."""

    def __init__(self, parts: list[bytes]):
        self.parts = parts

    def levels(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        shard = (keys % np.uint64(len(self.parts))).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(len(self.parts) + 1))
        for i, part in enumerate(self.parts):
            table = np.frombuffer(part, np.uint8)
            at, step = order[bounds[i] : bounds[i + 1]], 1
            while len(at):
                held = np.ones(len(at), bool)
                for bit in _bits(keys[at], step, 8 * len(table)):
                    held &= (table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                at = at[held]
                out[at] = step
                step += 1
        return out


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Numbers the blocks of a task: runs of rows with ``most`` characters at most (a longer text stands alone)."""
    number, total = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        sizes = [len(t or "") for t in batch.column(1).to_pylist()]
        start = 0
        for i, n in enumerate(sizes):
            if total and total + n > most:
                if i > start:
                    yield number, batch.slice(start, i - start)
                number, total, start = number + 1, 0, i
            total += n
        if len(sizes) > start:
            yield number, batch.slice(start)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order, and each value's place among them."""
    order = np.argsort(values)
    ranked = values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(fresh) - 1
    return ranked[fresh], place


def _sum_by_key(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    own, place = distinct(np.concatenate(keys))
    return own, np.bincount(place, np.concatenate(counts), len(own)).astype(np.int64)


def _split(keys: np.ndarray, counts: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    shard = keys % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    return keys[order], counts[order], np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))


def _pack(level: np.ndarray) -> bytes:
    return zlib.compress(level.astype(np.uint8).tobytes(), 1)


def _check(words_: np.ndarray, pairs: np.ndarray) -> int:
    """A sum that tells a block's keys of one shard from others."""
    return int(np.add.reduce(mix(words_.astype(np.uint64))) ^ np.add.reduce(mix(pairs.astype(np.uint64) + _GOLDEN))) >> 1


class _Counter:
    """Counts of one block. Pairs of the shard are told apart by 32 further bits of their hash."""

    def __init__(self, block: int):
        self.block, self.words, self.pairs, self.training, self.starts = block, [], [], [], 0

    def add(self, ids: list, texts: list) -> None:
        token, bounds = tokens(texts)
        trained = np.fromiter(map(is_training, ids), bool, len(ids))
        self.words.append(token)
        self.pairs.append(pair_hash(firsts(token, bounds), token))
        self.training.append(np.repeat(trained, np.diff(bounds)))
        self.starts += int(trained.sum())

    def rows(self, shards: int) -> pa.RecordBatch:
        """A row for each shard that the block has keys of: so many rows at most as the block has different keys."""
        own = _sum_by_key([*self.words, np.array([START])], [*self.training, np.array([self.starts])])
        words_, counts, at = _split(*own, shards)
        pairs, pair_counts, pair_at = _split(*_sum_by_key(self.pairs, self.training), shards)
        some = np.flatnonzero((np.diff(at) > 0) | (np.diff(pair_at) > 0))
        cut = lambda a, kind, at: pa.array([a[at[i] : at[i + 1]].astype(kind).tobytes() for i in some], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.full(len(some), self.block)), cut(words_, "<u8", at), cut(counts, "<u4", at), cut(pairs // np.uint64(shards), "<u4", pair_at), cut(pair_counts, "<u4", pair_at)], ["shard", "block", "words", "counts", "pairs", "pair_counts"])


def _read(column, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column]


def _pair_key(short: np.ndarray, shard: np.ndarray | int, shards: int) -> np.ndarray:
    """A pair's key in the filter: 32 bits of its hash beside its shard."""
    return short.astype(np.uint64) * np.uint64(shards) + np.asarray(shard, np.uint64)


def _gather(docs: DataFrame, shards: int, block_chars: int) -> DataFrame:
    """For each shard: a row with its sums, and a row for each block with its words' exact counts and all levels."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for block, batch in _blocks(batches, block_chars):
            if counter is None or counter.block != block:
                if counter:
                    yield counter.rows(shards)
                counter = _Counter(block)
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices([len(t or "") for t in texts], CHARS_AT_ONCE):
                counter.add(ids[a:b], texts[a:b])
        if counter:
            yield counter.rows(shards)

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[0])
        own, own_counts, own_pairs = _read(rows["words"], "<u8"), _read(rows["counts"], "<u4"), _read(rows["pairs"], "<u4")
        keys, counts = _sum_by_key(own, own_counts)
        pairs, pair_counts = _sum_by_key(own_pairs, _read(rows["pair_counts"], "<u4"))
        seen = (counts > 0) & (keys != START)
        pair_keys = _pair_key(pairs, shard, shards)
        held = Filter([make_slice(np.concatenate([keys[counts > 0], pair_keys[pair_counts > 0]]), np.concatenate([counts[counts > 0], pair_counts[pair_counts > 0]]))])
        level, pair_level = held.levels(keys), held.levels(pair_keys)
        at = [np.searchsorted(keys, k) for k in own]
        out = pd.DataFrame({"shard": shard, "block": rows["block"], "counts": [counts[i].astype("<u8").tobytes() for i in at], "levels": [_pack(level[i]) for i in at], "pair_levels": [_pack(pair_level[np.searchsorted(pairs, k)]) for k in own_pairs], "check": [_check(k, p) for k, p in zip(own, own_pairs)], "n": 0, "v": 0})
        head = pd.DataFrame([{"shard": shard, "block": None, "counts": None, "levels": None, "pair_levels": None, "check": 0, "n": int(counts[seen].sum()), "v": int(seen.sum())}])
        return pd.concat([head, out]).astype({"block": "Int64"})

    counted = docs.mapInArrow(count, "shard long, block long, words binary, counts binary, pairs binary, pair_counts binary")
    return counted.groupBy("shard").applyInPandas(merge, "shard long, block long, counts binary, levels binary, pair_levels binary, check long, n long, v long")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: held_out, n_tokens, n_known, train_tokens, base_score and score."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(FEWEST_SHARDS, -(-chars // SHARD_CHARS))
    gathered = cut_lineage(_gather(source, shards, block_chars))
    sums = gathered.filter("block is null").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    n_train, n_words = int(sums[0]), int(sums[1])
    blank = np.log10(n_train + 0.5 * (n_words + 1))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, batch in _blocks(batches, block_chars):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, block))], ["id", "text", "block"])

    def judge(key: tuple, rows: pa.Table, counts: pa.Table) -> pa.Table:
        ids, texts = rows.column("id").to_pylist(), rows.column("text")
        found = [tokens(texts.slice(a, b - a).to_pylist()) for a, b in slices([len(t.as_py() or "") for t in texts], CHARS_AT_ONCE)]
        token = np.concatenate([t for t, _ in found])
        bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(b) for _, b in found]))])
        known, at = distinct(np.append(token, START))
        pairs, pair_at = distinct(pair_hash(firsts(token, bounds), token))
        by_shard, order, cuts = _split(known, np.arange(len(known)), shards)
        pairs_by_shard, pair_order, pair_cuts = _split(pairs, np.arange(len(pairs)), shards)
        exact, held, pair_held = np.zeros(len(known)), np.zeros(len(known)), np.zeros(len(pairs))
        answer = {r["shard"]: r for r in counts.to_pylist()}
        some = np.flatnonzero((np.diff(cuts) > 0) | (np.diff(pair_cuts) > 0)).tolist()
        ok = sorted(answer) == some
        for i in some if ok else ():
            x, y, p, q = cuts[i], cuts[i + 1], pair_cuts[i], pair_cuts[i + 1]
            ok = ok and _check(by_shard[x:y], (pairs_by_shard[p:q] // np.uint64(shards)).astype("<u4")) == answer[i]["check"]
            if ok:
                exact[order[x:y]] = np.frombuffer(answer[i]["counts"], "<u8")
                held[order[x:y]] = np.frombuffer(zlib.decompress(answer[i]["levels"]), np.uint8)
                pair_held[pair_order[p:q]] = np.frombuffer(zlib.decompress(answer[i]["pair_levels"]), np.uint8)
        if not ok:
            raise RuntimeError("documents came in another order when they were read again; checkpoint them first")
        held, pair_held, starts = level_counts(held), level_counts(pair_held), bounds[:-1]
        at, begin = at[:-1], at[-1]
        before = np.concatenate([[begin], at[:-1]])
        before[starts] = begin
        word = np.minimum(1.0, (held + 0.5) / (n_train + 0.5 * (n_words + 1)))[at]
        chance = PAIR * np.minimum(1.0, pair_held[pair_at] / np.maximum(held, 1.0)[before]) + (1 - PAIR) * word
        base, seen = (np.log10(exact + 0.5) - blank)[at], (exact > 0)[at]
        columns = [np.diff(bounds), np.add.reduceat(seen, starts, dtype=np.int64), np.full(len(ids), n_train), np.add.reduceat(base, starts), np.add.reduceat(np.log10(chance), starts)]
        return pa.table([pa.array(ids, pa.int64()), pa.array([not is_training(i) for i in ids]), *(pa.array(c) for c in columns)], [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    placed = source.mapInArrow(place, "id long, text string, block long")
    answers = gathered.filter("block is not null").select("block", "shard", "counts", "levels", "pair_levels", "check")
    return placed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(judge, f"`{id_col}` long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

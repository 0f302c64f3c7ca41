"""Token ids in binary shards with a minimal perfect hash index: written in order of ids, read by scan or by key.

A folder holds ``manifest`` (Parquet, a row for each shard) and ``shards``. A shard is two files, all numbers little-endian:

- ``*.ids``: the ids of its documents one after the other and nothing else, 2 bytes each where the vocabulary allows, else 4.
- ``*.index``: a header of 8 longs (``HEADER``); the offsets of the documents in ids (documents + 1 longs); the keys in the order of
  the documents (longs); the slots (``SLOT``: fingerprint of the key, its first document, its number of documents); for each level of
  the hash its size in bits, and all levels' words of 64 bits with the number of bits set before each word.

The hash gives each of n keys a number of its own below n. Keys are hashed to the bits of a level; a bit that only one
key takes is set, the keys that share a bit go on to the next level, until none is left. A key's number is the count of
bits set before its own. A lookup looks at a level or two, at one slot and at two offsets, whatever the shard's size. A key
that is not there fails on its fingerprint of 32 bits; where that agrees by chance, on the key itself.

Shards are ranges of ids: tasks hold neighbouring ranges and start a new shard after ``SHARD_IDS`` ids. Which files count is
said by the manifest alone, so what a lost or repeated task leaves is never read. The folder may be anywhere that Arrow's
file systems reach (``file:``, ``hdfs:``, ``s3:``, ``gs:``).

Defined results: a null or empty text is the end id alone; rows of equal id keep their places side by side, in order of
their texts' hashes, and a key gives them all; null ids come after all others, are scanned, and are not found by key; an
empty table gives a manifest without rows; a text of any length is encoded whole; other columns are not read.
"""

from __future__ import annotations

import json
import os
import posixpath
import uuid
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, islice
from struct import Struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .arrow import bounded_batches
from .segments import mix, slices

END_ID = 1
#: Ids of a shard, about: 64 million, 128 or 256 MB; and its documents, whose keys and offsets a task holds.
SHARD_IDS, SHARD_DOCUMENTS = 1 << 26, 1 << 20
#: Ids read at once by a scan.
READ_IDS = 1 << 19
#: Bits of a level for each key that is still there.
ROOM = 2
#: Words and pre-tokens whose ids a worker keeps.
CACHED = 400_000
#: Characters that NFC leaves as they are whatever stands beside them: combining marks start here.
PLAIN = 0x300
#: Steps before the model that ``Encoder`` takes apart.
STEPS = ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]
#: Shards of a folder; their first keys (8 bytes each) are sent to all workers to route keys.
MOST_SHARDS = 1 << 20
HEADER = ("magic", "documents", "keys", "ids", "width", "levels", "words", "nulls")
MAGIC = 0x31584449
SLOT = np.dtype([("fingerprint", "<u4"), ("document", "<u4"), ("documents", "<u4")])
MANIFEST = "name string, documents long, keys long, ids long, first long, last long"


class Encoder:
    """The ids of texts as bytes, as the vocabulary's own library gives them for the whole text.

    The library's normaliser and pre-tokenizer drop white space and join nothing over it, so a text's ids are those of its
    words at ASCII white space. A word's ids are kept, from task to task; so are those of the pre-tokens that words consist of. Characters
    below ``PLAIN``, of which none combines with another, are normalised one by one, as the library does each, and
    pre-tokens of these go straight to the library's BPE model. All other words, and all words of a vocabulary with other
    steps than ``STEPS``, go through the library whole.
    """

    def __init__(self, json_path: str, cached: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self._tokenizer, self._most = Tokenizer.from_file(json_path), cached
        self.width = 2 if self._tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self._known: dict[bytes, bytes] = {b"": b""}
        self._packers = [Struct(f"<{n}{'H' if self.width == 2 else 'I'}").pack for n in range(64)]
        self._parts: dict[str, bytes] = {}
        with open(json_path, encoding="utf-8") as f:
            steps = json.load(f)
        splits = [x["pattern"]["Regex"] for x in (steps["pre_tokenizer"] or {}).get("pretokenizers", []) if x["type"] == "Split" and "Regex" in x["pattern"] and r"[\p{L}]+" in x["pattern"]["Regex"]]
        found = [x["type"] for kind, several in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")) for x in (steps[kind] or {}).get(several, [])]
        self._plain = self._split = self._special = None
        if found == STEPS and len(splits) == 1:
            plain = [c for c in map(chr, range(33, PLAIN)) if not c.isspace()]
            bytewise = self._tokenizer.pre_tokenizer[1] if hasattr(self._tokenizer.pre_tokenizer, "__getitem__") else None
            if bytewise is not None:
                self._lower = {ord(c): self._tokenizer.normalizer.normalize_str(c) for c in plain}
                self._bytes = {ord(c): bytewise.pre_tokenize_str(c)[0][0] for c in set("".join(self._lower.values()))}
                self._special = [x["content"] for x in steps["added_tokens"]]
                self._plain = regex.compile("[ " + "".join(map(regex.escape, plain)) + "]*").fullmatch
                self._split = regex.compile(splits[0]).findall

    def __call__(self, text: str | None) -> bytes:
        return self.each(pa.array([text], pa.string()))[0]

    def each(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of a column (null: none). Arrow cuts and numbers the words, so that each different word is looked up once."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        if not len(coded):
            return [b""] * len(texts)
        different = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist
        new = set(different).difference(self._known)
        if new:
            if len(self._known) + len(new) > self._most:
                self._known = {b"": b""} | dict(islice(self._known.items(), self._most // 2))  # those that came first are the frequent ones
                new = set(different).difference(self._known)
            self._learn([w for w in different if w in new])
        ids = pa.array([self._known[w] for w in different], pa.large_binary()).take(coded.indices)
        _, ends, raw = ids.buffers()
        at = np.frombuffer(ends, "<i8", len(ids) + 1)[words.offsets.to_numpy() - words.offsets[0].as_py()].tolist()
        raw = raw.to_pybytes() if raw else b""
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def _learn(self, new: list[bytes]) -> None:
        if self._plain is None:
            return self._learn_whole([w.decode() for w in new])
        joined = b" ".join(new).decode()
        if not self._simple(joined):
            texts = [w.decode() for w in new]
            simple = [self._simple(t) for t in texts]
            self._learn_whole([t for t, x in zip(texts, simple) if not x])
            texts = [t for t, x in zip(texts, simple) if x]
            new, joined = [t.encode() for t in texts], " ".join(texts)
            if not new:
                return
        if len(self._parts) > self._most:
            self._parts = dict(islice(self._parts.items(), self._most // 2))
        parts, known, packers = self._parts, self._known, self._packers
        cut = [self._cut(w) for w in joined.translate(self._lower).split(" ")]
        fresh = list(set(chain.from_iterable(cut)).difference(parts))
        tokenize = self._tokenizer.model.tokenize
        for part, bytewise in zip(fresh, " ".join(fresh).translate(self._bytes).split(" ")):
            made = [t.id for t in tokenize(bytewise)]
            parts[part] = packers[len(made)](*made) if len(made) < len(packers) else np.array(made, f"<u{self.width}").tobytes()
        for word, own in zip(new, cut):
            known[word] = parts[own[0]] if len(own) == 1 else b"".join([parts[x] for x in own])

    def _cut(self, word: str) -> Sequence[str]:
        """A word's pre-tokens; letters alone, or with one other character behind them, need no pattern."""
        if word.isalpha():
            return (word,)
        if word[:-1].isalpha():
            return word[:-1], word[-1]
        return self._split(word)

    def _simple(self, text: str) -> bool:
        return (text.isprintable() and max(text) < chr(PLAIN) or self._plain(text) is not None) and not any(x in text for x in self._special)

    def _learn_whole(self, texts: list[str]) -> None:
        for text, made in zip(texts, self._tokenizer.encode_batch(texts, add_special_tokens=False)):
            self._known[text.encode()] = np.array(made.ids, f"<u{self.width}").tobytes()


@lru_cache(1)
def encoder(json_path: str) -> Encoder:
    """A worker's own: the words that it has met serve its next tasks, too."""
    return Encoder(json_path)


def hashed(keys: np.ndarray, level: int) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64) + np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (hashed(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Numbers from 0 below n for n different keys of 64 bits."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, before: np.ndarray):
        self.sizes, self.words, self.before = sizes, words, before
        self._starts = np.concatenate([[0], np.cumsum(sizes)])

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits, left = [], [], keys
        while len(left):
            size = max(64, -(-ROOM * len(left) // 64) * 64)
            at = hashed(left, len(sizes)) % np.uint64(size)
            taken = np.bincount(at.astype(np.int64), minlength=size)
            sizes.append(size)
            bits.append(taken == 1)
            left = left[taken[at] > 1]
        every = np.concatenate(bits) if bits else np.zeros(0, bool)
        counts = every.reshape(-1, 64).sum(1)
        return cls(np.array(sizes, "<i8"), np.packbits(every, bitorder="little").view("<u8"), (np.cumsum(counts) - counts).astype("<u4"))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1, or another key's number, for a key that was not given at first."""
        found, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = (hashed(keys[left], level) % np.uint64(size)).astype(np.int64) + self._starts[level]
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            lower = word & ((np.uint64(1) << bit) - np.uint64(1))
            found[left[here]] = (self.before[at >> 6].astype(np.int64) + np.bitwise_count(lower))[here]
            left = left[~here]
        return found


class Shard:
    """A shard's index, opened; the payload is read by ranges."""

    def __init__(self, files, path: str):
        self._files, self._path = files, path
        with files.open_input_file(path + ".index") as f:
            raw = f.read()
        self.head = dict(zip(HEADER, np.frombuffer(raw, "<i8", len(HEADER)).tolist()))
        if self.head["magic"] != MAGIC:
            raise ValueError(f"{path} is not an index of token ids")
        h, self._raw, self._at = self.head, raw, 8 * len(HEADER)
        self.offsets = self._take("<i8", h["documents"] + 1)
        self.keys = self._take("<i8", h["documents"] - h["nulls"])
        self.slots = self._take(SLOT, h["keys"])
        self.hash = PerfectHash(self._take("<i8", h["levels"]), self._take("<u8", h["words"]), self._take("<u4", h["words"]))

    def _take(self, kind, n: int) -> np.ndarray:
        values = np.frombuffer(self._raw, kind, n, self._at)
        self._at += values.nbytes
        return values

    def documents(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each key the first document and the number of documents, 0 where the shard does not have it."""
        number = self.hash(keys)
        slot = self.slots[np.maximum(number, 0)] if len(self.slots) else np.zeros(len(keys), SLOT)
        there = (number >= 0) & (slot["fingerprint"] == fingerprints(keys))
        first = slot["document"].astype(np.int64)
        there[there] = self.keys[first[there]] == keys[there]
        return first, np.where(there, slot["documents"], 0).astype(np.int64)

    def payload(self):
        return self._files.open_input_file(self._path + ".ids")

    def ids(self, payload, first: int, documents: int = 1) -> np.ndarray:
        """The ids of neighbouring documents: a read of their own range of the payload."""
        a, b, width = int(self.offsets[first]), int(self.offsets[first + documents]), self.head["width"]
        return np.frombuffer(payload.read_at((b - a) * width, a * width), f"<u{width}").astype("<u4")


def file_system(folder: str):
    """Arrow's file system of a folder and the folder's path in it."""
    from pyarrow import fs

    local = folder.removeprefix("file:")
    if local.startswith("/"):
        return fs.LocalFileSystem(), "/" + local.lstrip("/")
    return fs.FileSystem.from_uri(folder)


class ShardWriter:
    """Writes one shard after the other into a folder, under names that no other attempt uses."""

    def __init__(self, folder: str, width: int, end_id: int, shard_ids: int, label: str):
        self._files, self._folder = file_system(folder)
        self._files.create_dir(self._folder)
        self._width, self._end, self._most, self._label = width, np.array([end_id], f"<u{width}").tobytes(), shard_ids, label
        self._count, self._payload = 0, None

    def add(self, doc: int | None, ids: bytes) -> None:
        if self._payload is None:
            self._name = f"{self._label}-{self._count:06d}"
            self._payload = self._files.open_output_stream(posixpath.join(self._folder, self._name + ".ids"))
            self._keys, self._nulls, self._offsets = array("q"), 0, array("q", [0])
            self._count += 1
        self._payload.write(ids + self._end)
        if doc is None:
            self._nulls += 1
        else:
            self._keys.append(doc)
        self._offsets.append(self._offsets[-1] + (len(ids) + len(self._end)) // self._width)

    @property
    def full(self) -> bool:
        return self._payload is not None and (self._offsets[-1] >= self._most or len(self._offsets) > SHARD_DOCUMENTS)

    def close(self) -> Iterator[tuple]:
        """Ends the shard, if one is open, and gives its row of the manifest."""
        if self._payload is None:
            return
        self._payload.close()
        self._payload = None
        keys, documents = np.frombuffer(self._keys, "<i8"), len(self._offsets) - 1
        different, first, counts = np.unique(keys, return_index=True, return_counts=True)
        made = PerfectHash.of(different)
        slots = np.zeros(len(different), SLOT)
        number = made(different)
        slots["fingerprint"][number], slots["document"][number], slots["documents"][number] = fingerprints(different), first, counts
        head = np.array([MAGIC, documents, len(different), self._offsets[-1], self._width, len(made.sizes), len(made.words), self._nulls], "<i8")
        with self._files.open_output_stream(posixpath.join(self._folder, self._name + ".index")) as f:
            for values in (head, np.frombuffer(self._offsets, "<i8"), keys, slots, made.sizes, made.words, made.before):
                f.write(values.tobytes())
        yield self._name, documents, len(different), self._offsets[-1], *((int(keys[0]), int(keys[-1])) if len(keys) else (None, None))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def write_ids(docs: DataFrame, folder: str, json_path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the documents' ids into a new folder and returns its manifest; see the module's text for the format."""
    spark = docs.sparkSession
    bounded_batches(spark)
    schema = pa.schema([("name", pa.string()), *((n, pa.int64()) for n in ("documents", "keys", "ids", "first", "last"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(json_path), TaskContext.get()
        writer = ShardWriter(posixpath.join(folder, "shards"), encode.width, end_id, shard_ids, f"{task.partitionId():06d}-{uuid.uuid4().hex[:8]}")
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encode.each(batch.column(1))):
                writer.add(doc, ids)
                if writer.full:
                    yield _batch(list(writer.close()), schema)
        pa.default_memory_pool().release_unused()  # the worker may stay idle from here on
        if rows := list(writer.close()):
            yield _batch(rows, schema)

    # Rows of equal id are dealt by text and, where that is equal too, by a number, so that no task gets them all.
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.monotonically_increasing_id()]
    own = own.select("*", order[1].alias("by_text"), order[2].alias("by_row"))
    order = [F.col("doc_id").asc_nulls_last(), "by_text", "by_row"]
    ranged = own.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ranged.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _shards(spark: SparkSession, folder: str) -> list[tuple[str, int, int | None, int | None]]:
    """(name, ids of all shards before, first key, last key) in order: a row for each shard, so bounded by ``MOST_SHARDS``."""
    rows = sorted(manifest(spark, folder).select("name", "ids", "first", "last").limit(MOST_SHARDS + 1).collect(), key=lambda r: [int(x) for x in r.name.split("-")[::2]])
    if len(rows) > MOST_SHARDS:
        raise ValueError(f"more than {MOST_SHARDS} shards: write with more ids a shard")
    out, start = [], 0
    for r in rows:
        out.append((r.name, start, r.first, r.last))
        start += r.ids
    return out


IDS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _scanned(shard: Shard, start: int, digests: bool) -> Iterator[pa.RecordBatch]:
    keys = pa.concat_arrays([pa.array(shard.keys, pa.int64()), pa.nulls(shard.head["nulls"], pa.int64())])
    with shard.payload() as payload:
        for a, b in slices(np.diff(shard.offsets).tolist(), READ_IDS):
            ids, offsets = shard.ids(payload, a, b - a), shard.offsets[a : b + 1]
            own = offsets - offsets[0]
            last = pa.array([zlib.crc32(ids[i:j]) for i, j in zip(own.tolist(), own[1:].tolist())], pa.int64()) if digests else pa.ListArray.from_arrays(pa.array(own, pa.int32()), pa.array(ids.view("<i4")))
            yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), pa.array(start + offsets[:-1], pa.int64()), pa.array(np.diff(offsets), pa.int64()), last], [*IDS.names[:3], "ids_crc32" if digests else "ids"])


def read_ids(spark: SparkSession, folder: str, digests: bool = False) -> DataFrame:
    """All documents of a folder in shards' order: doc_id, start (ids of all before it), n_tokens, and ids or their crc32.

    Every key goes through the hash and its fingerprint, so a damaged index raises an error and gives no wrong row.
    """
    shards = _shards(spark, folder)
    places = spark.createDataFrame([(n, s) for n, s, *_ in shards], "name string, start long").repartition(max(1, len(shards)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = file_system(folder)
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns)):
                shard = Shard(files, posixpath.join(path, "shards", name))
                keys = np.unique(shard.keys)
                first, counts = shard.documents(keys)
                if counts.sum() != len(shard.keys) or (np.sort(first) != np.searchsorted(shard.keys, keys)).any():
                    raise ValueError(f"the index of {name} does not fit its keys")
                yield from _scanned(shard, start, digests)

    return places.mapInArrow(run, f"doc_id long, start long, n_tokens long, {'ids_crc32 long' if digests else 'ids array<int>'}")


def lookup(keys: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, start, n_tokens, ids) for each row of ``keys`` and each document of that id; none for keys that are not there."""
    spark = keys.sparkSession
    bounded_batches(spark)
    shards = _shards(spark, folder)
    keyed = [s for s in shards if s[2] is not None]
    lasts, firsts = np.array([s[3] for s in keyed], np.int64), np.array([s[2] for s in keyed], np.int64)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
            a, b = np.searchsorted(lasts, own, "left"), np.searchsorted(firsts, own, "right")
            n = np.maximum(b - a, 0)
            at = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.repeat(own, n), pa.int64())], ["shard", "doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = file_system(folder)
        at, shard, payload = None, None, None
        for batch in batches:
            which, own = (c.to_numpy() for c in batch.columns)
            for k in np.unique(which).tolist():
                if k != at:
                    if payload:
                        payload.close()
                    at, shard = k, Shard(files, posixpath.join(path, "shards", keyed[k][0]))
                    payload = shard.payload()
                mine = own[which == k]
                rows, size = [], 0
                for doc, first, n in zip(mine.tolist(), *(x.tolist() for x in shard.documents(mine))):
                    for i in range(first, first + n):
                        ids = shard.ids(payload, i)
                        rows.append((doc, keyed[k][1] + int(shard.offsets[i]), len(ids), ids.view("<i4")))
                        size += len(ids)
                        if size > READ_IDS:
                            yield _batch(rows, IDS)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, IDS)
        if payload:
            payload.close()

    routed = keys.select(F.col(id_col).cast("long")).mapInArrow(route, "shard int, doc_id long")
    # a shard that many ask for is opened by several tasks
    dealt = routed.repartition("shard", F.pmod(F.xxhash64("doc_id"), F.lit(8))).sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids array<int>")


def digest(docs: DataFrame, json_path: str, folder: str | None = None) -> DataFrame:
    """Writes the ids into a new folder of the shared one, and reads from it (doc_id, start, n_tokens, ids_crc32)."""
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(docs, folder, json_path)
    return read_ids(spark, folder, digests=True)

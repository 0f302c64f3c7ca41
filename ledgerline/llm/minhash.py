"""Near duplicates by order MinHash, checked by banded alignment.

A text's items are its five-word windows (all its words, where there are fewer), each labelled with its occurrence
number. For each of ``SKETCHES`` hash functions the ``LENGTH`` smallest items are taken and kept in text order; the hash
of that tuple is one sketch, so that equal sketches need the same items in the same order. Short texts have further
sketches of ``SHORT_LENGTH`` items.

Texts that share a sketch are candidates. A pair is a link if the banded alignment of the two item sequences matches m
of a and b items with m / (a + b - m) >= ``SIMILARITY``. First every text is paired with the smallest id of each of its
buckets (an aggregate and a join: no task needs a whole bucket, and the number of partitions changes nothing). Then the
buckets that still hold several classes are compared: every text outside the bucket's largest class with all texts of
other classes, in blocks of ``BLOCK`` by ``BLOCK`` texts. There a pair is aligned unless the lengths or the bitmaps
(parities of the items' hashes, which differ in no more bits than items are unmatched) rule a link out; of two classes
the closest ``CLOSEST`` pairs go first, and the others follow if these leave the classes apart. Equal texts are one
vertex throughout; classes are the connected components.

The alignment is the longest common run of items in order, gaps allowed. Equal items are matched by occurrence number
first; if that is not enough, any occurrences inside the band may match, which is worked out for a whole band of places at
once, one bit a place. The band holds every place that a link could use, so that the answer is exact for texts of any length;
such a pair takes items times the band's places / 64 steps, and memory for some bands of bits.

Defined results: a null text is a class of its own and kept; equal texts, empty ones too, are copies; a text without
words has copies only. A null id never represents a class: such a row joins the class of its text's other rows and goes,
or, if all rows of its text have a null id, has a null class and stays. Rows that repeat an id share its class; when
documents are dropped, one of them stays. Ids are integers (other kinds are cast to long). An empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .arrow import annotate, grouped
from .columns import by_place, unused
from .components import more_trees, trees
from .segments import code_points, hashes, mix, words

WINDOW = 5
SIMILARITY = 0.8
SKETCHES, LENGTH = 24, 5
SHORT, SHORT_LENGTH = 16, 2
#: Texts of a bucket in one block, about; pairs of two classes that a block gives at first.
BLOCK, CLOSEST = 1024, 4
#: Bytes of places of repeated items that one alignment keeps at hand (others are made again when met).
PLACES_KEPT = 16 << 20
#: Bits of a text's bitmap (a long text's bitmap only rules out less).
LEAST_BITS, MOST_BITS = 1 << 8, 1 << 16
_FACTORS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def items(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each text's windows of words, in order, and the offset at which each text's windows start."""
    points, offsets = code_points(texts)
    starts, ends, n_words = words(points, offsets)
    word = hashes(points, starts, ends)
    counts = np.where(n_words >= WINDOW, n_words - WINDOW + 1, (n_words > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(n_words)])[:-1]
    bounds = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(first - bounds[:-1], counts) + np.arange(bounds[-1])
    left = np.repeat(first + n_words, counts) - at
    padded = np.concatenate([word, np.zeros(WINDOW, np.uint64)])
    value = np.zeros(len(at), np.uint64)
    for k in range(WINDOW):
        value = mix(value * np.uint64(3) + np.where(left > k, padded[at + k], np.uint64(k)))
    return value, bounds


def labelled(value: np.ndarray) -> np.ndarray:
    """Items made different by their occurrence number within one text."""
    value = value.astype(np.uint64)
    order = np.argsort(value, kind="stable")
    ranked = value[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(value) else order
    if len(starts) == len(value):
        return value
    number = np.arange(len(value)) - np.repeat(starts, np.diff(np.append(starts, len(value))))
    out = np.empty_like(value)
    out[order] = np.where(number > 0, mix(ranked + number.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)), ranked)
    return out


def _tuples(value: np.ndarray, length: int) -> np.ndarray:
    """One hash for each hash function: of the ``length`` smallest items, in text order."""
    hashed = value[None, :] * _FACTORS[:, None]
    hashed ^= hashed >> np.uint64(32)
    if len(value) > length:
        at = np.sort(np.argpartition(hashed, length - 1, axis=1)[:, :length], axis=1)
        taken = np.take_along_axis(hashed, at, axis=1)
    else:
        taken = hashed
    total = np.full(SKETCHES, np.uint64(length))
    for k in range(taken.shape[1]):
        total = mix(total * np.uint64(0x9FB21C651E98DF25) + taken[:, k])
    return total ^ mix(np.arange(SKETCHES, dtype=np.uint64) + np.uint64(977 * length))


def sketches(value: np.ndarray) -> np.ndarray:
    if not len(value):
        return np.zeros(0, np.uint64)
    own = labelled(value)
    full = _tuples(own, LENGTH)
    return np.concatenate([full, _tuples(own, SHORT_LENGTH)]) if len(own) <= SHORT else full


def _in_order(position: np.ndarray) -> int:
    """Length of the longest increasing run of positions, gaps allowed."""
    if (position[1:] > position[:-1]).all():
        return len(position)
    tails: list[int] = []
    for p in position.tolist():
        i = bisect_left(tails, p)
        if i == len(tails):
            tails.append(p)
        else:
            tails[i] = p
    return len(tails)


def _common_ends(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Equal items at the start and, after these, at the end of both."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    first = int(differ[0]) if len(differ) else n
    n -= first
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    return first, int(differ[0]) if len(differ) else n


def _bits(at: np.ndarray, width: int) -> int:
    if len(at) <= 4:
        return sum(1 << int(p) for p in at)
    flags = np.zeros(width, np.uint8)
    flags[at] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _any_occurrence(a: np.ndarray, b: np.ndarray, most: int, needed: int) -> bool:
    """Whether ``needed`` items match in order, any occurrences allowed, where at most ``most`` items may stay unmatched.

    A match d places off its own place leaves |d| items before it and |len(b) - len(a) - d| after it unmatched, so that only
    places of a band can be part of an answer. A bit of ``row`` is 0 where one more item of b's part up to it is matched; one
    item of a is a few operations on the band's bits. Rows are taken in runs, between which the band moves on.
    """
    start, end = _common_ends(a, b)
    needed -= start + end
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if needed <= 0:
        return True
    apart = len(b) - len(a)
    low, high = (apart - most) // 2, (apart + most) // 2 + 1
    order = np.argsort(b, kind="stable")
    first, last = np.searchsorted(b, a, "left", order), np.searchsorted(b, a, "right", order)
    run = max(256, (high - low) // 2)
    passed, left, row, size = 0, 0, 0, 0
    for begin in range(0, len(a), run):
        stop = min(begin + run, len(a))
        to = max(left, min(len(b), max(0, begin + low)))
        upto = max(to, min(len(b), stop + high))
        gone = min(to - left, size)
        passed += gone - (row & ((1 << gone) - 1)).bit_count()
        row >>= gone
        size -= gone
        left = to
        row |= ((1 << (upto - left - size)) - 1) << size
        size = upto - left
        every, kept, room = (1 << size) - 1, {}, PLACES_KEPT
        for i in range(begin, stop):
            if first[i] == last[i]:
                continue
            places = kept.get(first[i])
            if places is None:
                at = order[first[i] : last[i]]
                at = at[np.searchsorted(at, left) : np.searchsorted(at, upto)] - left
                places = _bits(at, size)
                if len(at) > 1 and room >= size // 8:
                    kept[first[i]] = places
                    room -= size // 8
            met = row & places
            if met:
                row = ((row + met) | (row - met)) & every
        matched = passed + size - row.bit_count()
        if matched >= needed or matched + len(a) - stop < needed:
            return matched >= needed
    return False


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether the banded alignment of two item sequences matches enough of them."""
    n = len(a) + len(b)
    enough = lambda m: m >= least * (n - m) - 1e-9
    if not enough(min(len(a), len(b))):
        return False
    own_a, own_b = labelled(a), labelled(b)
    _, pa_, pb_ = np.intersect1d(own_a, own_b, assume_unique=True, return_indices=True)
    if not enough(len(pa_)):
        return False
    most = int(n * (1 - least) / (1 + least) + 1e-9)
    near = np.abs(pa_ - pb_) <= most
    if enough(_in_order(pa_[near][np.argsort(pb_[near])])):
        return True
    repeated = (own_a != a).any() or (own_b != b).any()
    return bool(repeated) and _any_occurrence(a, b, most, math.ceil((least * n - 1e-9) / (1 + least)))


def _digest(text: str) -> F.Column:
    return F.unhex(F.md5(F.col(text).cast("binary")))


def _buckets(leading: DataFrame) -> DataFrame:
    """(sketch, n, leader, id) of all buckets of two texts or more; the leader is the smallest id."""
    rows = leading.select("id", F.explode(F.array_distinct("sketches")).alias("sketch"))
    several = rows.groupBy("sketch").agg(F.count("*").alias("n"), F.min("id").alias("leader")).filter("n > 1")
    return rows.join(several, "sketch").select("sketch", "n", "leader", "id")


def _links(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    """The pairs (u, v) that the alignment confirms; ``sequences`` has id and items."""
    both = pairs.select("u", "v").join(sequences.select(F.col("id").alias("u"), F.col("items").alias("a")), "u").join(sequences.select(F.col("id").alias("v"), F.col("items").alias("b")), "v").select("u", "v", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            keep = [similar(np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)) for x, y in zip(a, b)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "u long, v long")


def bitmap(value: np.ndarray) -> bytes:
    """Parity of the labelled items at each place of a table that grows with their number."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (2 * len(value)).bit_length()))
    at = (mix(labelled(value)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1, bitorder="little").tobytes()


def possible(sizes: np.ndarray, marks: list[bytes], of: np.ndarray, side: np.ndarray, least: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows a and b of a block's pairs of different classes that may be links, and the bits that set them apart.

    ``side`` 0 and 1 mark two sets of texts, of which only cross pairs count; 2 is one set, of which all pairs count.
    """
    widths = np.array([len(m) for m in marks])
    found = [(np.zeros(0, np.int64),) * 3]
    for width in np.unique(widths):
        own, wide = np.flatnonzero(widths == width), np.flatnonzero(widths == 2 * width)
        bits = np.frombuffer(b"".join(marks[i] for i in own), np.uint64).reshape(len(own), -1)
        folded = np.frombuffer(b"".join(marks[i] for i in wide), np.uint64).reshape(len(wide), 2, bits.shape[1])
        at, bits = np.concatenate([own, wide]), np.concatenate([bits, folded[:, 0] ^ folded[:, 1]])
        larger = int((side[at] == 1).sum() > (side[at] == 0).sum())
        for k, a in enumerate(at):
            # Each cross pair is met from the side with fewer texts; a pair of two wide texts waits for its own width.
            if side[a] == 2:
                rest = np.arange(k + 1, len(at)) if k < len(own) else ()
            elif side[a] == 1 - larger:
                rest = np.flatnonzero(side[at[: len(at) if k < len(own) else len(own)]] == larger)
            else:
                continue
            if not len(rest):
                continue
            b = at[rest]
            rest = rest[(of[b] != of[a]) & (np.minimum(sizes[a], sizes[b]) >= least * np.maximum(sizes[a], sizes[b]) - 1e-6)]
            if not len(rest):
                continue
            apart = np.bitwise_count(bits[rest] ^ bits[k]).sum(1, dtype=np.int64)
            near = apart <= (sizes[a] + sizes[at[rest]]) * (1 - least) / (1 + least) + 1e-6
            found.append((np.full(int(near.sum()), a), at[rest[near]], apart[near]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _mixed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """The members of buckets with several classes: (sketch, n, others, id, of, other).

    ``other`` marks those outside the bucket's largest class; ``others`` is their number.
    """
    placed = members.filter("n > 2").select("sketch", "id").join(classes.select(F.col("vertex").alias("id"), "component"), "id", "left").select("sketch", "id", F.coalesce("component", "id").alias("of"))
    sizes = placed.groupBy("sketch", "of").agg(F.count("*").alias("c"))
    info = sizes.groupBy("sketch").agg(F.sum("c").alias("n"), F.max("c").alias("most"), F.max_by("of", F.struct("c", "of")).alias("largest")).filter("n > most")
    return placed.join(info, "sketch").select("sketch", "n", (F.col("n") - F.col("most")).alias("others"), "id", "of", (F.col("of") != F.col("largest")).alias("other"))


def _across(mixed: DataFrame, marks: DataFrame, block: int, closest: int | None) -> DataFrame:
    """(p, q, u, v, more): pairs (u, v) of the classes p and q that may be links.

    With ``closest`` so many pairs of two classes at most, the closest, from each block; ``more`` says that there are
    others. Every text outside its bucket's largest class meets all blocks of the bucket.
    """
    parts = lambda n: F.ceil(F.col(n) / block).cast("int")
    own = lambda n: F.pmod(F.xxhash64("id"), parts(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), parts(n) - 1))
    kept = ["sketch", "id", "of", "other"]
    targets = mixed.select(*kept, F.lit(0).cast("long").alias("side"), own("n").alias("low"), every("others").alias("high"))
    asking = mixed.filter("other").select(*kept, F.lit(1).cast("long").alias("side"), every("n").alias("low"), own("others").alias("high"))
    names = ["sketch", "low", "high"]
    dealt = targets.unionByName(asking).select("sketch", F.col("low").cast("long"), F.col("high").cast("long"), "id", "of", "other", "side")
    rows = dealt.join(marks, "id").select(*names, "id", "of", "other", "side", "size", "mark").repartition(*names).sortWithinPartitions(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 3):
            key = np.column_stack([table.column(i).to_numpy() for i in range(3)])
            ids, of, other, side, sizes = (table.column(i).to_numpy() for i in range(3, 8))
            marks = table.column(8).to_pylist()
            cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [len(ids)]])
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if (of[x:y] == of[x]).all():
                    continue
                a, b, apart = possible(sizes[x:y], marks[x:y], of[x:y], side[x:y])
                a, b = a + x, b + x
                twice = other[a] & other[b]
                once = ~twice | ((ids[a] < ids[b]) == (side[a] == 1))
                a, b, apart = a[once], b[once], apart[once]
                p, q = np.minimum(of[a], of[b]), np.maximum(of[a], of[b])
                more = np.zeros(len(a), bool)
                if closest and len(a):
                    order = np.lexsort((apart, q, p))
                    a, b, p, q = (z[order] for z in (a, b, p, q))
                    starts = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (q[1:] != q[:-1])]))
                    counts = np.diff(np.append(starts, len(a)))
                    first = np.arange(len(a)) - np.repeat(starts, counts) < closest
                    more = np.repeat(counts > closest, counts)
                    a, b, p, q, more = (z[first] for z in (a, b, p, q, more))
                u, v = np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])
                yield pa.RecordBatch.from_arrays([*(pa.array(z.astype(np.int64)) for z in (p, q, u, v)), pa.array(more)], ["p", "q", "u", "v", "more"])

    return rows.mapInArrow(run, "p long, q long, u long, v long, more boolean")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, closest: int = CLOSEST) -> DataFrame:
    """(id, class_id, kept) for each document: its class's smallest id, and whether this row stays for its class."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def make():
        def apply(texts):
            value, bounds = items(texts)
            own = [sketches(value[a:b]).view(np.int64) for a, b in zip(bounds[:-1], bounds[1:])]
            return [pa.array(own, pa.list_(pa.int64()))]

        return apply

    sketched = annotate(source, make, "sketches array<long>", [_digest("text").alias("digest")], "id", "text")
    rows = cut_lineage(sketched.filter("digest is not null"))
    copies = rows.groupBy("digest").agg(F.min("id").alias("rep"))
    leading = rows.filter("id is not null and size(sketches) > 0").groupBy("digest").agg(F.min(F.struct("id", "sketches")).alias("x")).select("x.*")
    members = cut_lineage(_buckets(leading))

    def shingled():
        def apply(texts):
            value, bounds = items(texts)
            short = (value >> np.uint64(32)).astype(np.uint32)
            return [pa.array([short[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())]

        return apply

    wanted = members.select("id").distinct()
    sequences = cut_lineage(annotate(source.filter("id is not null and text is not null").join(wanted, "id", "left_semi"), shingled, "items binary", [], "id", "text"))
    several = rows.filter("id is not null").groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a <> b").select("id")
    repeated = rows.join(several, "id", "left_semi").select(F.col("id").alias("u"), "digest").join(copies, "digest").select("u", F.col("rep").alias("v"))
    leads = members.filter("id <> leader").select(F.col("leader").alias("u"), F.col("id").alias("v")).distinct()
    classes = trees(_links(leads, sequences).unionByName(repeated))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(x.as_buffer(), np.uint32) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in own], pa.int64()), pa.array([bitmap(x) for x in own], pa.binary())], ["id", "size", "mark"])

    mixed = cut_lineage(_mixed(members, classes))
    if not mixed.isEmpty():
        marks = cut_lineage(sequences.join(mixed.select("id").distinct(), "id", "left_semi").select("id", "items").mapInArrow(marked, "id long, size long, mark binary"))
        found = cut_lineage(_across(mixed, marks, block, closest))
        classes = more_trees(classes, _links(found.select("u", "v").distinct(), sequences))
        now = lambda side: classes.select(F.col("vertex").alias(side), F.col("component").alias(f"to_{side}"))
        told = found.filter("more").select("p", "q").distinct().join(now("p"), "p", "left").join(now("q"), "q", "left")
        left = cut_lineage(told.select(F.coalesce("to_p", "p").alias("p"), F.coalesce("to_q", "q").alias("q")).filter("p <> q").select(F.explode(F.array("p", "q")).alias("of")).distinct())
        if not left.isEmpty():
            again = cut_lineage(_mixed(members, classes).join(left, "of", "left_semi"))  # else made twice, for both sides of the blocks
            rest = _across(again, marks, block, None)
            classes = more_trees(classes, _links(rest.select("u", "v").distinct(), sequences))

    named = copies.join(classes, copies["rep"] == classes["vertex"], "left").select("digest", F.coalesce("component", "rep").alias("class_id"))
    judged = rows.select("id", "digest").join(named, "digest").select("id", "class_id")
    alone = source.filter("text is null").select("id", F.col("id").alias("class_id"))
    return judged.unionByName(alone).select(F.col("id").alias(id_col), "class_id", F.coalesce(F.col("id") == F.col("class_id"), F.col("class_id").isNull()).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns kept, with one document of each class; of rows that repeat its id, one stays.

    A null text stays. A row with a null id stays if no row of its text has an id. An empty table gives no rows.
    """
    names, docs = docs.columns, by_place(docs, id_col, text_col)
    judged = cut_lineage(near_duplicates(docs, id_col, text_col))
    known = judged.filter(F.col(id_col).isNotNull())
    repeated = cut_lineage(known.groupBy(id_col).agg(F.count("*").alias("n")).filter("n > 1").select(id_col))
    gone = known.filter("not kept").select(id_col).distinct()
    stays = docs.filter(F.col(id_col).isNotNull()).join(gone, id_col, "left_anti")
    if not repeated.isEmpty():
        stays = stays.join(repeated, id_col, "left_anti").unionByName(stays.join(repeated, id_col, "left_semi").dropDuplicates([id_col]))
    if known.count() < judged.count():
        digest = unused(docs, "digest")
        nameless = docs.filter(F.col(id_col).isNull())
        represented = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(_digest(text_col).alias(digest)).distinct()
        stays = stays.unionByName(nameless.withColumn(digest, _digest(text_col)).join(represented, digest, "left_anti").drop(digest))
    return stays.select(docs.columns).toDF(*names)

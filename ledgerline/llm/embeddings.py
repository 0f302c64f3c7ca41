"""Near duplicates among vectors by Euclidean p-stable hashing, with exact cosine checks.

Normalised vectors fall into buckets: in each of several tables a key joins ``k`` quantised random projections,
floor((a.v + b) / WIDTH). ``tables_for`` sets k and the number of tables from the number of vectors, with one rule at
every size: a bucket holds about ``BUCKET`` unrelated vectors, and a pair at the threshold shares no bucket with a chance
of ``MISS``.

Vectors do not travel to the buckets: a row there holds the vector's number and its components rounded to one byte each,
with the length of what was rounded off. Pairs of a bucket that the rounded vectors and these lengths rule out are passed
over (no link is lost by that); the others are candidates, and only their vectors are fetched and compared exactly, in
double precision. A bucket with more than ``DENSE`` candidates a vector gives no pairs: its vectors are fetched and
compared inside the bucket, so that a cluster gives counts and one edge a vector, and never all its pairs. A pair counts
in the first table that brings it together, so that link counts are exact for the pairs found. Buckets above ``BLOCK``
vectors are cut into blocks that are compared two at a time. Equal vectors are one vector with a weight.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components links with nothing, is its
own component and kept; so does any row with a null id (null component, kept). Vectors of different dimensions never
link. Components of any finite size are allowed. Ids are integers (other kinds are cast to long). Rows that repeat an id
are vectors of their own that share a component. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .arrow import grouped
from .components import components, local_components
from .segments import mix, spread

LEAST_COSINE = 0.9
WIDTH = 2.5
MISS = 0.004
BUCKET, BLOCK = 1024, 1024
#: Hash functions in a key at least.
FEWEST = 4
#: Candidates for each vector of a bucket, beyond which the vectors themselves come to the bucket.
DENSE = 8
SEED = 20_11


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised projection agrees for two vectors at a Euclidean distance."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables_for(n: int, least: float = LEAST_COSINE, miss: float = MISS) -> tuple[int, int]:
    """Hash functions in a key, and tables, for n vectors."""
    near, far = collision(math.sqrt(2 - 2 * least)), collision(math.sqrt(2))
    k = max(FEWEST, math.ceil(math.log(max(n, BUCKET) / BUCKET) / -math.log(far)))
    return k, math.ceil(math.log(miss) / math.log(1 - near**k))


def bucket_keys(unit: np.ndarray, k: int, tables: int) -> np.ndarray:
    """Each vector's 32-bit key in each table."""
    draw = np.random.default_rng([SEED, unit.shape[1]])
    a, b = draw.standard_normal((unit.shape[1], k * tables)), draw.uniform(0, WIDTH, k * tables)
    cell = np.floor((unit @ a + b) / WIDTH).astype(np.int64).astype(np.uint64).reshape(len(unit), tables, k)
    key = np.full(cell.shape[:2], np.uint64(unit.shape[1])) + mix(np.arange(tables, dtype=np.uint64))
    for i in range(k):
        key = mix(key * np.uint64(0x9FB21C651E98DF25) + cell[:, :, i])
    return (key >> np.uint64(32)).astype(np.uint32)


def rounded(unit: np.ndarray) -> list[bytes]:
    """Each vector in one byte a component, after the step and the length of what is rounded off (two 32-bit floats)."""
    step = np.abs(unit).max(1, keepdims=True, initial=0) / 127
    whole = np.rint(unit / np.where(step > 0, step, 1)).astype(np.int8)
    off = np.sqrt(((unit - whole * step.astype(np.float32).astype(np.float64)) ** 2).sum(1, keepdims=True)) + 1e-6
    head = np.column_stack([step, off]).astype("<f4").view(np.uint8).reshape(len(unit), 8)
    return [row.tobytes() for row in np.column_stack([head, whole.view(np.uint8)])]


def _unit(rows) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that no square over- or underflows."""
    vectors = np.array(rows, np.float64)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length and start of each list, and all values in a row; nulls become NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lengths, np.cumsum(lengths) - lengths, column.flatten().to_numpy(zero_copy_only=False)


def _by_size(lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for size in np.unique(lengths):
        yield int(size), np.flatnonzero(lengths == size)


def compare(ids: np.ndarray, weight: np.ndarray, unit: np.ndarray, keys: np.ndarray, side: np.ndarray, group: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links inside each group (rows of a group adjoin): per row, the weight of its new links and its component's id.

    ``side`` 0 and 1 mark two blocks of one bucket, of which only cross pairs count; 2 is a whole bucket or block.
    ``group`` holds the table's number in its last column.
    """
    bounds = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]).any(1), [True]]))
    links, found = np.zeros(len(ids), np.int64), [(np.zeros(0, np.int64),) * 2]
    for start, end in zip(bounds[:-1], bounds[1:]):
        for first in range(start, end, 256):
            own = slice(first, min(first + 256, end))
            near = unit[own] @ unit[start:end].T >= least
            near &= np.arange(start, end)[None, :] > np.arange(own.start, own.stop)[:, None]
            near &= (side[own] == 2)[:, None] | (side[own][:, None] != side[start:end])
            a, b = np.nonzero(near)
            found.append((a + first, b + start))
    a, b = (np.concatenate(x) for x in zip(*found))
    table = group[a, -1]
    fresh = np.ones(len(a), bool)
    for t in range(int(table.max(initial=0))):
        later = table > t
        fresh[later] &= keys[a[later], t] != keys[b[later], t]
    np.add.at(links, a[fresh], weight[b[fresh]])
    np.add.at(links, b[fresh], weight[a[fresh]])
    order = np.argsort(ids, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(ids))
    lows = ids[order][local_components(len(ids), rank[a], rank[b])][rank]
    return links, lows, np.flatnonzero((links > 0) | (lows != ids))


def candidates(codes: list[bytes], side: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows a and b of one group that their rounded vectors do not rule out."""
    found = [(np.zeros(0, np.int64),) * 2]
    for size, rows in _by_size(np.array([len(c) for c in codes])):
        table = np.frombuffer(b"".join(codes[i] for i in rows), np.uint8).reshape(len(rows), size)
        step, off = (x[:, 0] for x in np.split(np.ascontiguousarray(table[:, :8]).view("<f4"), 2, axis=1))
        whole, own_side = np.ascontiguousarray(table[:, 8:]).view(np.int8).astype(np.float32) * step[:, None], side[rows]
        for start in range(0, len(rows), 256):
            own = slice(start, start + 256)
            slack = off[own, None] + off[None, :] + off[own, None] * off[None, :] + 1e-5
            near = (whole[own] @ whole.T >= least - slack) & ((own_side[own] == 2)[:, None] | (own_side[own, None] != own_side[None, :]))
            a, b = np.nonzero(near)
            a = a + start
            found.append((rows[a[a < b]], rows[b[a < b]]))
    return tuple(np.concatenate(x) for x in zip(*found))


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, dense: int = DENSE) -> DataFrame:
    """One row per vector: id, n_links, component_id and kept."""
    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    doubles = lambda df: df.select("id", F.col("vector").cast("array<double>").alias("vector"))
    k, tables = tables_for(vectors.count(), least)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, starts, flat = _lists(batch.column(1))
            usable = np.array([i is not None for i in batch.column(0).to_pylist()], bool)
            for size, rows in _by_size(lengths):
                own = flat[spread(starts[rows], lengths[rows])].reshape(len(rows), size) + 0.0
                ok = usable[rows] & (np.isfinite(own).all(1) & (own != 0).any(1) if size else np.zeros(len(rows), bool))
                own, rows = own[ok], np.concatenate([rows[ok], rows[~ok]])
                unit = _unit(own) if len(own) else np.zeros((0, max(size, 1)))
                pad = lambda made: pa.array([*made, *([None] * (len(rows) - len(own)))], None)
                columns = [pad([blake2b(v.tobytes(), digest_size=16).digest() for v in own]).cast(pa.binary()), pad(rounded(unit)).cast(pa.binary())]
                keys = pa.array([*bucket_keys(unit, k, tables).view(np.int32), *([None] * (len(rows) - len(own)))], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *columns, keys], ["id", "digest", "code", "keys"])

    known = cut_lineage(doubles(source).mapInArrow(hashed, "id long, digest binary, code binary, keys array<int>"))
    usable = known.filter("digest is not null")
    grouped_ = usable.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("weight"), *(F.first(c).alias(c) for c in ("code", "keys")))
    distinct = cut_lineage(grouped_.withColumn("n", F.monotonically_increasing_id()))

    placed = distinct.select("n", "code", F.posexplode("keys").alias("t", "key"))
    placed = placed.select("n", "code", F.shiftleft(F.col("t").cast("long"), 32).bitwiseOR(F.col("key").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("key"))
    counted = placed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = placed.join(counted, "key").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    dealt = shared.withColumn("own", F.pmod(F.xxhash64("n"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    dealt = dealt.select("key", F.shiftleft(F.least("own", "other").cast("long"), 32).bitwiseOR(F.greatest("own", "other").cast("long")).alias("part"), "n", side.cast("long").alias("side"), "code")
    names = ["key", "part"]

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 2):
            key, part, own, side = (table.column(i).to_numpy() for i in range(4))
            codes = table.column(4).to_pylist()
            cuts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1]), [True]]))
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if y - x < 2:
                    continue
                a, b = candidates(codes[x:y], side[x:y], least)
                if len(a) > dense * (y - x):
                    u = v = pa.nulls(1, pa.int64())
                elif len(a):
                    u, v = (pa.array(z) for z in (np.minimum(own[a + x], own[b + x]), np.maximum(own[a + x], own[b + x])))
                else:
                    continue
                yield pa.RecordBatch.from_arrays([u, v, pa.array(np.full(len(u), key[x])), pa.array(np.full(len(u), part[x]))], ["u", "v", "key", "part"])

    found = cut_lineage(dealt.repartition(*names).sortWithinPartitions(*names).mapInArrow(paired, "u long, v long, key long, part long"))
    pairs = found.filter("u is not null").groupBy("u", "v").agg(F.min(F.shiftright("key", 32)).alias("t"))
    crowded = cut_lineage(found.filter("u is null").select(*names))
    inside = dealt.join(crowded, names, "left_semi").select(*names, "n", "side")
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("n")).unionByName(inside.select("n")).distinct()

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, starts, flat = _lists(batch.column(1))
            flat = flat + 0.0
            said = [blake2b(flat[s : s + n].tobytes(), digest_size=16).digest() for s, n in zip(starts.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(said, pa.binary()), batch.column(1)], ["digest", "vector"])

    asked = cut_lineage(distinct.select("n", "id", "weight", "digest", "keys").join(wanted, "n", "left_semi"))
    fetched = doubles(source.join(asked.select("id").distinct(), "id", "left_semi")).mapInArrow(named, "digest binary, vector array<double>").dropDuplicates(["digest"])
    fetched = cut_lineage(asked.join(fetched, "digest").drop("digest"))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (size_a, at_a, a), (size_b, at_b, b) = _lists(batch.column(7)), _lists(batch.column(8))
            keys = [_lists(batch.column(i))[2].reshape(batch.num_rows, -1) for i in (9, 10)]
            same = keys[0] == keys[1]
            first = np.where(same.any(1), same.argmax(1), -1)
            keep = np.zeros(batch.num_rows, bool)
            for size, rows in _by_size(np.where(size_a == size_b, size_a, 0)):
                if size:
                    x, y = (_unit(flat[spread(at[rows], np.full(len(rows), size))].reshape(len(rows), size)) for flat, at in ((a, at_a), (b, at_b)))
                    keep[rows] = np.einsum("ij,ij->i", x, y) >= least
            keep &= first == batch.column(2).to_numpy()
            yield batch.select([0, 1, 3, 4, 5, 6]).filter(pa.array(keep))

    ends = lambda x: fetched.select(*(F.col(c).alias(n) for c, n in zip(("n", "id", "weight", "vector", "keys"), x)))
    both = pairs.join(ends(("u", "id_u", "w_u", "x", "keys_u")), "u").join(ends(("v", "id_v", "w_v", "y", "keys_v")), "v")
    linked = cut_lineage(both.select("u", "v", F.col("t").cast("long"), "id_u", "id_v", "w_u", "w_v", "x", "y", "keys_u", "keys_v").mapInArrow(exact, "u long, v long, id_u long, id_v long, w_u long, w_v long"))
    counts = linked.select(F.col("u").alias("n"), F.col("w_v").alias("links")).unionByName(linked.select(F.col("v").alias("n"), F.col("w_u").alias("links")))
    edges = linked.select(F.col("id_u").alias("u"), F.col("id_v").alias("v"))

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 2):
            group = np.column_stack([table.column(0).to_numpy(), table.column(1).to_numpy(), table.column(0).to_numpy() >> 32])
            own, side, ids, weight = (table.column(i).to_numpy() for i in range(2, 6))
            lengths, starts, flat = _lists(table.column(6))
            keys = _lists(table.column(7))[2].reshape(len(own), -1)
            for size, rows in _by_size(lengths):
                unit = _unit(flat[spread(starts[rows], lengths[rows])].reshape(-1, size))
                links, low, some = compare(ids[rows], weight[rows], unit, keys[rows], side[rows], group[rows], least)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (own[rows][some], links[some], ids[rows][some], low[some])], ["n", "links", "u", "v"])

    if not crowded.isEmpty():
        rows = inside.join(fetched, "n").select(*names, "n", "side", "id", "weight", "vector", "keys").repartition(*names).sortWithinPartitions(*names)
        more = cut_lineage(rows.mapInArrow(within, "n long, links long, u long, v long"))
        counts, edges = counts.unionByName(more.select("n", "links")), edges.unionByName(more.select("u", "v"))

    several = usable.groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a <> b").select("id")
    repeated = usable.join(several, "id", "left_semi").select(F.col("id").alias("u"), "digest").join(distinct.select("digest", F.col("id").alias("v")), "digest")
    classes = components(edges.unionByName(repeated.select("u", "v")))
    sums = counts.groupBy("n").agg(F.sum("links").alias("links"))
    made = distinct.select("n", "id", "digest", "weight").join(sums, "n", "left").join(classes.withColumnRenamed("vertex", "id"), "id", "left")
    made = made.select("digest", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    result = usable.select("id", "digest").join(made, "digest").select("id", "n_links", "component_id")
    rest = known.filter("digest is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return result.unionByName(rest).select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))

"""Whitening of vectors by a one-sided Jacobi singular value decomposition.

Entries become integers, so that counts, sums and deviations are exact. Every task compresses its centred rows block by
block to a triangle R (QR of the triangle so far and the next block, TSQR); triangles are merged by ``MERGED`` at a time,
a table of them at each step, until one is left. Plane rotations then orthogonalise R's columns; the rotations taken
together are the components, the columns' norms the standard deviations. No covariance matrix is formed, so small
deviations keep all their digits.

Only R, a square of the dimension, reaches the driver; a dimension of ``MOST_DIMENSIONS`` bounds it.

Defined results: rows whose vector is null or holds null or non-finite entries go, and so do vectors of another length
than the most frequent one (of two as frequent, the longer) and empty ones; a null id stays null; equal rows count and
are returned each; entries whose integer passes 2**52 stop there. A component without variance has whitened null and
explained 0 (all have explained null if no vector varies); identity_error looks at the others and is null if there are
none. A deviation that no long holds is null. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import bounded_batches

#: Fixed values of the integers: floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 1024, 100_000
LIMIT = 1 << 52
COMPONENTS = 8
MOST_DIMENSIONS = 4096
#: Rows of a block, and triangles that a task merges.
BLOCK, MERGED = 2048, 16
#: Cosine of two columns that counts as a right angle, and rounds of rotations after which an error is raised.
RIGHT_ANGLE, MOST_SWEEPS = 1e-15, 60
#: A standard deviation below this share of the largest one is none: rounding alone may have made it.
LEAST_SHARE = 1e-13
COLUMNS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Model:
    """What the vectors' integers have in common: their number, sums, components (columns) and standard deviations."""

    n: int
    sums: list[int]
    components: np.ndarray
    deviations: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        """Each component's share of the trace of the covariance; not numbers if nothing varies."""
        e = self.deviations**2
        with np.errstate(invalid="ignore"):
            return e / e.sum()

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n; the sums' whole and broken parts are taken off one after the other, so nothing is lost."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        return (x - whole) - np.array([s % self.n for s in self.sums], float) / self.n

    def whitened(self, x: np.ndarray, k: int) -> np.ndarray:
        """Not a number in the columns of components without variance."""
        scale = self.deviations[:k].copy()
        scale[scale <= LEAST_SHARE * self.deviations[0]] = np.nan
        return self.centred(x) @ self.components[:, :k] / scale

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The exact sum over dimensions of (n * x - S) ** 2 of each row."""
        most = max((abs(self.n * int(v) - s) for row in (x.min(0), x.max(0)) for v, s in zip(row, self.sums)), default=0)
        if most**2 * len(self.sums) < 1 << 63:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def _integers(column: pa.Array, length: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a legal vector (of ``length``, if given), and the vectors' integers."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten()
    fine = np.isfinite(pc.fill_null(values.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False))
    ends = np.cumsum(sizes)
    good = np.concatenate([[0], np.cumsum(fine)])
    keep = (sizes > 0) & (good[ends] - good[ends - sizes] == sizes)
    if length is None:
        return keep, sizes
    keep &= sizes == length
    own = values.to_numpy(zero_copy_only=False).astype(float)[np.repeat(keep, sizes)].reshape(-1, length)
    with np.errstate(over="ignore"):
        own = own * SCALE
    return keep, np.clip(np.floor(own), -LIMIT, LIMIT).astype(np.int64) + SHIFT


def _blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            keep, x = _integers(part.column(part.num_columns - 1), length)
            if len(x):
                yield part, keep, x


def rotated(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-sided Jacobi: (components as columns, norms) of the rows that R stands for, by falling norm.

    Columns meet in pairs as in a tournament, half of them at once; a sweep lets each pair meet once. Sweeps end when all
    pairs are at right angles.
    """
    n = r.shape[1]
    m = n + n % 2
    a, v = np.zeros((len(r), m)), np.eye(m)
    largest = np.abs(r).max(initial=0)
    if not largest:
        return v[:n, :n], np.zeros(n)
    a[:, :n] = r / largest
    tiny = (LEAST_SHARE * np.linalg.norm(a)) ** 2
    for _ in range(MOST_SWEEPS):
        seats, worst = np.arange(m), 0.0
        for _ in range(m - 1):
            i, j = seats[: m // 2], seats[m // 2 :][::-1]
            left, right = a[:, i], a[:, j]
            p, q, c = (left**2).sum(0), (right**2).sum(0), (left * right).sum(0)
            turn = (np.abs(c) > RIGHT_ANGLE * np.sqrt(p * q)) & (np.maximum(p, q) > 0)
            real = turn & (np.minimum(p, q) > tiny)
            if real.any():
                worst = max(worst, float((np.abs(c[real]) / np.sqrt(p[real] * q[real])).max()))
            if turn.any():
                i, j, p, q, c = i[turn], j[turn], p[turn], q[turn], c[turn]
                zeta = (q - p) / (2 * c)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
                cos = 1 / np.hypot(1, t)
                sin = cos * t
                for x in (a, v):
                    x[:, i], x[:, j] = x[:, i] * cos - x[:, j] * sin, x[:, i] * sin + x[:, j] * cos
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst <= 100 * RIGHT_ANGLE:
            break
    else:
        raise ArithmeticError("rotations do not settle")
    norms = np.linalg.norm(a, axis=0)
    order = np.argsort(-norms, kind="stable")
    order = order[order < n] if m > n else order
    return v[:n][:, order], norms[order] * largest


def _merge(triangles: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.concatenate(triangles), mode="r")


def _moments(y: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    mean = y.mean(0)
    return len(y), mean, (y - mean).T @ (y - mean)


def _joined(a: tuple | None, b: tuple) -> tuple:
    """The moments of two lots of rows together, from those of each."""
    if a is None:
        return b
    n, shift = a[0] + b[0], b[1] - a[1]
    return n, a[1] + shift * (b[0] / n), a[2] + b[2] + np.outer(shift, shift) * (a[0] * b[0] / n)


def _gathered(vectors: DataFrame, length: int, add: Callable, join: Callable[[list[bytes]], bytes]) -> list[bytes]:
    """What ``add`` makes of each task's blocks, joined by ``MERGED`` at a time in tasks until one is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for _, _, x in _blocks(batches, length):
            made = add(made, x)
        if made is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([made], pa.binary())], ["at", "made"])

    def several(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"at": [int(key[0])], "made": [join(list(rows.sort_values("at").made))]})

    parts, made = vectors.rdd.getNumPartitions(), vectors.mapInArrow(run, "at long, made binary")
    while parts > 1:
        made = made.groupBy(F.floor(F.col("at") / MERGED).alias("to")).applyInPandas(several, "at long, made binary")
        parts = -(-parts // MERGED)
    return [r.made for r in made.collect()]


def fit(vectors: DataFrame, vec_col: str = "embedding") -> Model | None:
    """The model of all legal vectors; None if there are none."""
    bounded_batches(vectors.sparkSession)
    own = vectors.select(F.col(vec_col).cast("array<double>").alias("v"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for batch in batches:
            keep, sizes = _integers(batch.column(0), None)
            for length in np.unique(sizes[keep]).tolist():
                for _, _, x in _blocks(iter([batch]), length):
                    counts[length] = counts.get(length, 0) + len(x)
                    halves = (x & 0xFFFFFFFF).sum(0).tolist(), (x >> 32).sum(0).tolist()  # so that no long overflows
                    sums[length] = [a + low + (high << 32) for a, low, high in zip(sums.get(length, [0] * length), *halves)]
        rows = [(length, i, counts[length], str(s)) for length, mine in sums.items() for i, s in enumerate(mine)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["length", "at", "n", "s"])

    parts = own.mapInArrow(add, "length long, at long, n long, s string")
    totals = parts.groupBy("length", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    first = totals.filter("at = 0").orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    if not first:
        return None
    length, n = first[0].length, first[0].n
    if length > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {length} dimensions; {MOST_DIMENSIONS} at most")
    sums = [int(r.s) for r in sorted(totals.filter(F.col("length") == length).collect(), key=lambda r: r["at"])]
    model = Model(n, sums, np.eye(length), np.ones(length))
    read = lambda raw: np.frombuffer(raw, "<f8").reshape(-1, length)
    merge = lambda raws: _merge([read(x) for x in raws]).astype("<f8").tobytes()
    compress = lambda r, x: _merge([model.centred(x)] if r is None else [read(r), model.centred(x)]).astype("<f8").tobytes()
    triangle = read(merge(_gathered(own, length, compress, merge)))
    model.components, norms = rotated(triangle)
    model.deviations = norms / np.sqrt(n)
    return model


def whiten(vectors: DataFrame, model: Model, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, whitened array, deviation) of each legal vector; see the module's text for the defined cases."""
    bounded_batches(vectors.sparkSession)
    k = min(components, len(model.sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, keep, x in _blocks(batches, len(model.sums)):
            y = pa.array(model.whitened(x, k).ravel(), from_pandas=True)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * k + 1, k), pa.int32()), y)
            yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(keep)), rows, pa.array(model.deviation(x), pa.int64())], ["vec_id", "whitened", "deviation"])

    own = vectors.select(F.col(id_col).cast("long"), F.col(vec_col).cast("array<double>"))
    return own.mapInArrow(run, "vec_id long, whitened array<double>, deviation long")


def identity_error(vectors: DataFrame, model: Model, components: int = COMPONENTS, vec_col: str = "embedding") -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    k = int((model.deviations[: min(components, len(model.sums))] > LEAST_SHARE * model.deviations[0]).sum())
    if not k:
        return None
    write = lambda m: np.concatenate([[m[0]], m[1], m[2].ravel()]).astype("<f8").tobytes()
    read = lambda raw: (lambda v: (v[0], v[1 : k + 1], v[k + 1 :].reshape(k, k)))(np.frombuffer(raw, "<f8"))
    add = lambda m, x: write(_joined(read(m) if m else None, _moments(model.whitened(x, k))))

    def join(raws: list[bytes]) -> bytes:
        total = None
        for raw in raws:
            total = _joined(total, read(raw))
        return write(total)

    own = vectors.select(F.col(vec_col).cast("array<double>").alias("v"))
    n, _, products = read(join(_gathered(own, len(model.sums), add, join)))
    return float(np.abs(products / n - np.eye(k)).max())


def digest(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each legal vector and component, with what holds for all of them; see the module's text."""
    spark = vectors.sparkSession
    model = fit(vectors)
    if model is None:
        return spark.createDataFrame([], COLUMNS)
    share = [None if np.isnan(x) else float(x) for x in model.explained[:components]]
    error = identity_error(vectors, model, components)
    rows = whiten(vectors, model, components).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*(F.lit(x).cast("double") for x in share))[F.col("at")].alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )

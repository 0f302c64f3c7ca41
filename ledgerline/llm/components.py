"""Connected components of a graph given as an edge table.

Edges are contracted inside each task first: a task replaces its edges by stars around the smallest vertex of each of
its own components, which keeps all connections and at most one edge a vertex. Then alternating star steps follow: each
vertex hands the smallest vertex it knows to its larger neighbours, then to its smaller ones; every step ends with the
contraction again and a checkpoint in the shared folder. Hub vertices only meet partial aggregates and joins that AQE
can split. The end is told from the edges themselves: stars, each around a vertex that points nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

MOST_STEPS = 60
#: Edges that a task contracts at once: bounds its memory, whatever it holds in all.
EDGES_AT_ONCE = 2_000_000


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of n vertices."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges as stars: every vertex but the smallest of each component, and that smallest one."""
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    label = local_components(len(names), at[: len(u)], at[len(u) :])
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[moved], names[label[moved]]


def contract(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v: what each task's edges come down to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        give = lambda: pa.RecordBatch.from_arrays([pa.array(x) for x in stars(*(np.concatenate(x) for x in zip(*held)))], ["u", "v"])
        for batch in batches:
            if batch.num_rows:
                held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
                n += batch.num_rows
            if n >= EDGES_AT_ONCE:
                yield give()
                held, n = [], 0
        if held:
            yield give()

    return edges.select("u", "v").filter("u <> v").mapInArrow(run, "u long, v long")


def _both_ways(edges: DataFrame) -> DataFrame:
    """Each edge and its reverse, in one reading of the edges."""
    pair = lambda a, b: F.struct(F.col(a).alias("u"), F.col(b).alias("v"))
    return edges.select(F.explode(F.array(pair("u", "v"), pair("v", "u"))).alias("x")).select("x.u", "x.v")


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges lead from a larger vertex to a smaller one already."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _open(edges: DataFrame) -> bool:
    """Whether some vertex points at two others, or at one that points further."""
    ends = _both_ways(edges).groupBy("u").agg(F.count_if(F.col("v") < F.col("u")).alias("out"), F.max(F.col("v") > F.col("u")).alias("hit"))
    return not ends.filter("out > 1 or (out = 1 and hit)").isEmpty()


def trees(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of the edges (u, v) that is not the smallest of its component, which is what
    the component is; written once.

    Loops, repeated edges and edges with a null are allowed. The edges are read once.
    """
    edges = cut_lineage(contract(edges))
    for _ in range(MOST_STEPS):
        if not _open(edges):
            return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
        edges = cut_lineage(contract(_small_star(_large_star(edges)).repartition("u")))
    raise RuntimeError(f"no fixed point after {MOST_STEPS} steps")


def more_trees(grown: DataFrame, links: DataFrame) -> DataFrame:
    """The ``trees`` (vertex, component) after more links (u, v): only the components that the links join are worked on."""
    of = lambda side: F.coalesce(f"of_{side}", side).alias(side)
    named = lambda side: grown.select(F.col("vertex").alias(side), F.col("component").alias(f"of_{side}"))
    joined = trees(links.join(named("u"), "u", "left").join(named("v"), "v", "left").select(of("u"), of("v")))
    moved = joined.select(F.col("vertex").alias("component"), F.col("component").alias("__to"))
    kept = grown.join(moved, "component", "left").select("vertex", F.coalesce("__to", "component").alias("component"))
    return cut_lineage(kept.unionByName(joined))  # what moved was the smallest of its component: no vertex of ``grown``


def _with_smallest(grown: DataFrame) -> DataFrame:
    return grown.unionByName(grown.select(F.col("component").alias("vertex"), "component").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of the edges (u, v); the component is its smallest vertex.

    Loops, repeated edges and edges with a null are allowed; a vertex with loops only is not in the result. The edges
    are read once.
    """
    return _with_smallest(trees(edges))


def further(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes (vertex, component) after more links (u, v): only the classes that the links join are worked on."""
    return _with_smallest(more_trees(classes.filter("vertex <> component"), links))

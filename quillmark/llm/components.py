"""Connected components of an edge table: contraction by parts, then alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, materialise

#: Edges that one task contracts.
PART_EDGES = 500_000


def merge(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the classes of a[i] and b[i] in ``roots``, where each place holds the least place of its class."""
    while True:
        ra, rb = roots[a], roots[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(roots, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while not np.array_equal(up := roots[roots], roots):
            roots[:] = up


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the least of its component, for all nodes but these."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    roots = np.arange(len(nodes))
    merge(roots, place[: len(u)], place[len(u) :])
    moved = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[moved], nodes[roots[moved]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    u = v = np.zeros(0, np.int64)
    for batch in batches:
        u, v = (np.concatenate([x, batch.column(k).to_numpy()]) for k, x in enumerate((u, v)))
        if len(u) >= 2 * PART_EDGES:  # a forest has fewer edges than nodes
            u, v = stars(u, v)
            if len(u) >= PART_EDGES:
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                u = v = np.zeros(0, np.int64)
    u, v = stars(u, v)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _star(directed: DataFrame) -> DataFrame:
    """Adds to each edge (u, v) the least of u and its v's; the minimum is combined before the shuffle."""
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return directed.join(least, "u")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_steps: int = 60, part_edges: int = PART_EDGES) -> DataFrame:
    """From undirected edges ``a, b`` (long): ``node, root``, root being the least node reachable.

    Only nodes with an edge to another node are returned. Tasks first replace
    their edges by a star for each component that these make, which leaves
    nothing to do where one task has all of them. Otherwise each step's edges
    are written to the shared folder, so a lost executor costs one step; the
    number of steps grows with the logarithm of the longest chain. A step writes
    no more files than the cluster has cores: edges are few beside documents.
    """
    cores = edges.sparkSession.sparkContext.defaultParallelism
    given = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct().coalesce(cores), "edges")
    parts = -(-given.count() // part_edges)
    dealt = given.coalesce(1) if parts <= 1 else given.repartition(parts, "v")
    now = materialise(dealt.mapInArrow(_contracted, "u long, v long"), "edges")
    drop_table(given)
    mark = None if parts <= 1 else _mark(now)
    for _ in range(max_steps if parts > 1 else 0):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _star(large)
        after = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = materialise(after.coalesce(cores), "edges")
        drop_table(now)
        before, now, mark = mark, after, _mark(after)
        if before == mark:
            break
    else:
        if parts > 1:
            raise RuntimeError(f"components aren't settled after {max_steps} steps")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

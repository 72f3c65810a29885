"""Distributed union-find: connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyspark.llm.common import written


#: So many edges, counted, are tied together by one task.
SMALL_EDGES = 20_000


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one small table."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if a != b:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["node", "root"])


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Edges without loops and repeats as a written table, and their number and combined hash."""
    seen = Observation()
    edges = edges.filter("a <> b").select("a", "b").distinct()
    edges = written(edges.observe(seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("all")), "edges")
    return edges, (seen.get["n"], seen.get["all"])


def components(edges: DataFrame, native: bool = False) -> DataFrame:
    """Of a written table of edges ``a``-``b``: ``node`` and ``root`` (the smallest node of its component) for every node.

    Rounds of large-star and small-star moves: each node's greater neighbours are tied to its
    smallest one, then its smaller neighbours are; the edges end as stars around the roots.  Minima
    are pre-aggregated, so a node with very many edges is no single task's work.  Loops and
    repeated edges do not matter; no edges give no rows.  A table that is counted to have ``SMALL_EDGES`` at most, or so many different ones,
    is done by one task instead of many rounds of nearly empty ones, unless ``native`` asks for DataFrame operations only.
    """
    if not native and edges.count() <= SMALL_EDGES:
        return edges.select("a", "b").coalesce(1).mapInArrow(_united, "node long, root long")
    edges, sign = _kept(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    if not native and sign[0] <= SMALL_EDGES:
        return edges.coalesce(1).mapInArrow(_united, "node long, root long")
    before = None
    while sign[0] and sign != before:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("m"))
        # Greater neighbours go to the smallest node around.
        large = both.filter("b > a").join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # Now every edge leads from a to a smaller b: the smaller ones and the node go to the smallest.
        smallest = large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        small = large.join(smallest, F.col("a") == F.col("node")).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        before = sign
        edges, sign = _kept(small)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())

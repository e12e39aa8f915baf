"""Connected components by alternating large and small stars, on edges that are cut down per task first."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, settle

_EDGES = "a long, b long"


def roots(pairs: list[tuple[int, int]]) -> dict[int, int]:
    """Union-find over some edges: each node with the smallest one it is tied to."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(parent)}


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one Arrow batch as stars: same components, at most one edge a node."""
    for batch in batches:
        found = roots(list(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)))
        links = [(x, r) for x, r in found.items() if x != r]
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([r for _, r in links], pa.int64())}
        )


def _round(edges: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """One large star and one small star; the least neighbours are written, so that the joins with them are
    plain shuffles in which a node with many edges is split."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    around = settle(least, "least")
    # Each node's larger neighbours are tied to the smallest node around it.
    large = both.join(around, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    large = settle(large, "edges")
    # Each node's smaller neighbours are tied to the smallest of them.
    below = settle(large.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = large.join(below, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    small = settle(moved.union(below.select("a", F.col("m").alias("b"))).distinct(), "edges")
    return small, [around, large, below]


def connected(edges: DataFrame) -> DataFrame:
    """(a, b) edges of longs in, (node, component) out: the smallest node reachable.

    Only nodes that have an edge to another node appear. Self edges, repeated edges and both
    directions are fine; nulls are ignored; no edges give no rows. The number of rounds grows with
    the logarithm of the longest path; the driver sees a count and a checksum a round.
    """
    clean = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = settle(clean.mapInArrow(_local, _EDGES).distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if mark == seen or mark["n"] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen, before = mark, now
        now, used = _round(now)
        for step in (before, *used):
            forget(step)

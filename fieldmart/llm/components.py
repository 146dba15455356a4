"""Connected components of an edge table, by star contraction.

Every round hangs each node's larger neighbours (large star) and then its smaller ones
(small star) on the smallest neighbour; after a number of rounds that grows with the
logarithm of the graph each component is a star around its smallest node. Tasks first
shrink their own edges to a spanning forest, so the rounds see few edges. Every round is a
written table, joined between two exchanges that adaptive execution splits at hot nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import materialized


def root(parent: dict[int, int], node: int) -> int:
    """The node's root, halving the way to it."""
    while (up := parent.setdefault(node, node)) != node:
        parent[node] = node = parent[up]
    return node


def union(parent: dict[int, int], a: int, b: int) -> bool:
    """Join two trees under the smaller root; false if they were one."""
    a, b = root(parent, a), root(parent, b)
    if a == b:
        return False
    parent[max(a, b)] = min(a, b)
    return True


#: Edges that a task turns into a forest at a time.
FOREST_EDGES = 200_000


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit():
        pairs = [(n, r) for n in list(parent) if (r := root(parent, n)) != n]
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["u", "v"])

    parent: dict[int, int] = {}
    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            union(parent, u, v)
        if len(parent) > FOREST_EDGES:
            yield emit()
            parent = {}
    yield emit()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component): each node of an edge and the smallest node it is connected with."""
    bigger = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).filter("u <> v")
    edges = materialized(bigger.mapInArrow(_forests, "u long, v long").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialized(both.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m")).select(
            "v", F.least("v", "m").alias("m")), "large-least")
        large = materialized(edges.join(least, "v").select("u", F.col("m").alias("v")).filter("u <> v").distinct(), "large-star")
        least = materialized(large.groupBy("u").agg(F.min("v").alias("m")), "small-least")
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialized(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return materialized(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres), "components")

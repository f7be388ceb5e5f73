"""Connected components of an edge table: distributed union-find.

Each task unions a bounded number of edges and keeps a spanning forest; the
number of tasks follows the number of edges.  Rounds of hooking to the smallest
neighbour then shrink every component to a star.  The minimum per node is an
aggregate with a map-side part, and joining it back is a plain join that AQE
can split, so a hub with a large share of all edges is never gathered in one
place.  Every round is written to the shared folder, which cuts the lineage and
lets a lost executor's work be redone from files; the round before it is
deleted then, so the disk holds two rounds at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop_tables, freed_shuffles, of_table, ship, write_table

# Edges that one task unions at a time: bounds its memory.
LOCAL_EDGES = 1 << 18


def union(a: list[int], b: list[int]) -> dict[int, int]:
    """Union-find with path halving; maps each node to its smallest member."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a, b):
        p, q = find(x), find(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
    return {x: find(x) for x in list(parent)}


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def forest(a: list[int], b: list[int]) -> pa.RecordBatch:
        m = union(a, b)
        kept = [(x, r) for x, r in m.items() if x != r]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in kept], pa.int64()),
                                           pa.array([r for _, r in kept], pa.int64())], ["src", "dst"])
    a: list[int] = []
    b: list[int] = []
    for x in batches:
        a += x.column(0).to_pylist()
        b += x.column(1).to_pylist()
        if len(a) >= LOCAL_EDGES:
            yield forest(a, b)
            a, b = [], []
    if a:
        yield forest(a, b)


def _forest(e: DataFrame, n: int) -> DataFrame:
    """Spanning forests of the (about ``n``) edges, by tasks of bounded size."""
    return e.coalesce(max(1, -(-n // LOCAL_EDGES))).mapInArrow(_local, "src long, dst long")


def _is_star(e: DataFrame) -> bool:
    """Whether each node has one smaller neighbour that has none itself."""
    twice = e.groupBy("src").agg(F.min("dst").alias("lo"), F.max("dst").alias("hi")).where("lo < hi").select("src")
    deep = e.select("src").join(e.select(F.col("dst").alias("src")).distinct(), "src", "left_semi")
    with freed_shuffles(e.sparkSession):
        return twice.unionByName(deep).isEmpty()


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node of the edges; ``component`` is the
    smallest node of its component.  Loops and repeated edges do no harm, rows
    with a null end are no edges; no edges give an empty table.  The caller may
    drop the table behind the result."""
    ship(edges.sparkSession)
    e = (edges.select(F.col(src).cast("long").alias("src"), F.col(dst).cast("long").alias("dst"))
         .where("src is not null and dst is not null and src <> dst"))
    e = write_table(e, "edges")
    n = e.count()
    e = _instead(e, _forest(e, n))
    # Forests of one task are stars; those of several meet in common nodes.
    while n > LOCAL_EDGES and not _is_star(e):
        # Larger neighbours of every node hook to the smallest node around it ...
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        large = both.where("dst > src").join(low, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        large = large.distinct()
        # ... and smaller ones, with the node itself, to the smallest of them.
        low = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = (large.join(low, "src").where("dst <> m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
                 .unionByName(low.select("src", F.col("m").alias("dst"))))
        e = _instead(e, small.where("src <> dst").distinct())
    return of_table(e.select(F.col("src").alias("node"), F.col("dst").alias("component"))
                    .unionByName(e.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()), e)


def _instead(e: DataFrame, after: DataFrame) -> DataFrame:
    """``after`` as a table, in place of the table ``e`` that it is made of."""
    table = write_table(after, "edges")
    drop_tables(e)
    return table


def local_components(a: np.ndarray, b: np.ndarray) -> dict[int, int]:
    """The same for edges that fit in one place (tests, one block of a task)."""
    return union(list(map(int, a)), list(map(int, b)))

"""Verified links inside candidate clusters, over R-tree leaves.

The points of each cluster are sorted and packed into leaves of bounded size
with a bounding box, so a cluster of any size is spread over tasks.  Leaf pairs
whose boxes cannot reach the needed overlap are dropped, then point pairs by
the same bound (the sum of the coordinate minima), and what survives is
verified on the whole sets.  A task returns a spanning forest of the links it
verified and their number per node, never the links themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import union
from .shared import drop_tables, write_table
from .textarrays import mix

DIMS = 64              # coordinates of a point: hash groups of a set's members
LEAF_ROWS = 192
LEAF_MEMBERS = 1 << 18

POINTS = "cluster long, node long, weight long, n long, c0 long, c1 long, pt binary, body binary"


def point(s: np.ndarray) -> np.ndarray:
    """Counts of the set's members per hash group."""
    return np.bincount((mix(s ^ np.uint64(0x165667B19E3779F9)) >> np.uint64(58)).astype(np.int64), minlength=DIMS)


def point_rows(cluster: pa.Array, node: pa.Array, weight: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
    """Rows of the ``POINTS`` schema for some sets (sorted distinct hashes)."""
    pts = [point(s) for s in sets]
    return pa.RecordBatch.from_arrays(
        [cluster, node, weight, pa.array([len(s) for s in sets], pa.int64()),
         pa.array([int(p[:DIMS // 2].sum()) for p in pts], pa.int64()),
         pa.array([int(p[::2].sum()) for p in pts], pa.int64()),
         pa.array([p.astype(np.int32).tobytes() for p in pts], pa.binary()),
         pa.array([s.tobytes() for s in sets], pa.binary())],
        ["cluster", "node", "weight", "n", "c0", "c1", "pt", "body"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the sorted points into leaves: runs of one cluster of bounded size."""
    part, seq = TaskContext.get().partitionId(), 0
    rows: list[dict] = []
    held = 0

    def leaf() -> pa.RecordBatch:
        p = np.stack([np.frombuffer(r["pt"], np.int32) for r in rows])
        n = [r["n"] for r in rows]
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[0]["cluster"]], pa.int64()), pa.array([(part << 32) | seq], pa.int64()),
             pa.array([min(n)], pa.int64()), pa.array([max(n)], pa.int64()),
             pa.array([p.max(0).tolist()], pa.list_(pa.int32())),
             pa.array([[r["node"] for r in rows]], pa.list_(pa.int64())),
             pa.array([[r["weight"] for r in rows]], pa.list_(pa.int64())),
             pa.array([n], pa.list_(pa.int64())),
             pa.array([p.tobytes()], pa.binary()), pa.array([b"".join(r["body"] for r in rows)], pa.binary())],
            ["cluster", "leaf", "n_min", "n_max", "high", "nodes", "weights", "sizes", "pts", "bodies"])

    for b in batches:
        for r in b.to_pylist():
            if rows and (r["cluster"] != rows[0]["cluster"] or len(rows) >= LEAF_ROWS
                         or held + r["n"] > LEAF_MEMBERS):
                yield leaf()
                rows, held, seq = [], 0, seq + 1
            rows.append(r)
            held += r["n"]
    if rows:
        yield leaf()


def links_between(left: dict, right: dict, same: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two leaves that link: ``100 * overlap >= percent * union``."""
    _, code = np.unique(np.concatenate([left["body"], right["body"]]), return_inverse=True)
    code_l, code_r = code[:len(left["body"])], code[len(left["body"]):]
    off_l, off_r = np.append(0, np.cumsum(left["n"])), np.append(0, np.cumsum(right["n"]))
    mark = np.zeros(int(code.max()) + 1 if len(code) else 1, bool)
    got_a, got_b = [], []
    for i, n in enumerate(left["n"]):
        lo = i + 1 if same else 0
        cand = np.arange(lo, len(right["n"]))
        size = right["n"][lo:]
        bound = np.minimum(right["pts"][lo:], left["pts"][i]).sum(1)     # summed coordinate minima
        cand = cand[((100 + percent) * bound >= percent * (n + size))
                    & (100 * np.minimum(size, n) >= percent * np.maximum(size, n))]
        if not len(cand):
            continue
        mine = code_l[off_l[i]:off_l[i + 1]]
        mark[mine] = True
        seen = np.zeros(len(code_r) + 1, np.int64)
        np.cumsum(mark[code_r], out=seen[1:])
        both = seen[off_r[cand + 1]] - seen[off_r[cand]]
        mark[mine] = False
        cand = cand[(100 + percent) * both >= percent * (n + right["n"][cand])]
        got_a.append(np.full(len(cand), i))
        got_b.append(cand)
    if not got_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(got_a), np.concatenate(got_b)


def _verifier(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def leaf(r: dict, k: str) -> dict:
        n = np.array(r["sizes" + k], np.int64)
        return {"n": n, "nodes": np.array(r["nodes" + k], np.int64), "w": np.array(r["weights" + k], np.int64),
                "pts": np.frombuffer(r["pts" + k], np.int32).reshape(len(n), DIMS),
                "body": np.frombuffer(r["bodies" + k], np.uint64)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                x, y = leaf(r, "1"), leaf(r, "2")
                i, j = links_between(x, y, r["leaf1"] == r["leaf2"], percent)
                if not len(i):
                    continue
                weight: dict[int, int] = {}
                for own, w in ((x["nodes"][i], y["w"][j]), (y["nodes"][j], x["w"][i])):
                    u, inv = np.unique(own, return_inverse=True)
                    for node, total in zip(u.tolist(), np.bincount(inv, w).astype(np.int64).tolist()):
                        weight[node] = weight.get(node, 0) + total
                root = union(x["nodes"][i].tolist(), y["nodes"][j].tolist())
                nodes = list(root)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array([root[v] for v in nodes], pa.int64()),
                     pa.array([weight[v] for v in nodes], pa.int64())], ["src", "dst", "links"])

    return run


_LEAF = ("cluster long, leaf long, n_min long, n_max long, high array<int>, nodes array<long>, "
         "weights array<long>, sizes array<long>, pts binary, bodies binary")


def _leaves(points: DataFrame) -> DataFrame:
    order = ["cluster", "n", "c0", "c1", "node"]
    return write_table(points.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pack, _LEAF), "leaves")


def _in_reach(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """Leaves of the same cluster, one of each table, whose boxes allow a link."""
    box = ("leaf", "n_min", "n_max", "high")
    a = left.select("cluster", *(F.col(c).alias(c + "1") for c in box))
    b = right.select("cluster", *(F.col(c).alias(c + "2") for c in box))
    reach = F.aggregate(F.zip_with("high1", "high2", lambda x, y: F.least(x, y)),
                        F.lit(0).cast("long"), lambda s, v: s + v)
    return (a.join(b, "cluster")
            .where(f"100 * n_max1 >= {percent} * n_min2 and 100 * n_max2 >= {percent} * n_min1")
            .where(F.lit(100 + percent) * reach >= F.lit(percent) * (F.col("n_min1") + F.col("n_min2")))
            .select("leaf1", "leaf2"))


def _verify(pairs: DataFrame, left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """Links between the leaves ``leaf1`` of one table and ``leaf2`` of the other.

    Both joins are dealt by leaf beforehand: a leaf has at most a row for each
    other leaf of its cluster, which streams past its one body, and Spark needn't
    cut a task per body because bodies are large."""
    for k, leaves in (("1", left), ("2", right)):
        body = leaves.select(*(F.col(c).alias(c + k) for c in ("leaf", "nodes", "weights", "sizes", "pts", "bodies")))
        pairs = pairs.repartition("leaf" + k).join(body.repartition("leaf" + k), "leaf" + k)
    return write_table(pairs.mapInArrow(_verifier(percent), "src long, dst long, links long"), "links")


def verified_links(points: DataFrame, percent: int) -> DataFrame:
    """``(src, dst, links)`` for the points of each cluster: rows with
    ``src <> dst`` form spanning forests of the links; ``links`` summed over
    the rows of a ``src`` is the total weight of the nodes it links to (if each
    node is in one cluster)."""
    leaves = _leaves(points)
    pairs = _in_reach(leaves, leaves, percent).where("leaf1 <= leaf2")
    links = _verify(pairs, leaves, leaves, percent)
    drop_tables(leaves)
    return links

"""Connected components of a link table: contraction in one task, or alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbiscope.llm.common import cut

#: Edges that a task contracts at a time.
LOCAL_EDGES = 1 << 16
#: Link tables of up to this many edges are contracted whole, in one task (16 bytes an edge).
HELD_EDGES = 1 << 20


def contract(edges: list[tuple[int, int]]) -> dict[int, int]:
    """node -> smallest node of its component, for every node of ``edges``."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


class Stars:
    """Edges gathered in a task, given out as stars that connect the same nodes."""

    def __init__(self):
        self.edges: list[tuple[int, int]] = []

    def add(self, edges: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        """Gather ``edges``; a batch comes out only when LOCAL_EDGES are held."""
        self.edges += edges
        if len(self.edges) >= LOCAL_EDGES:
            yield self.batch()

    def batch(self) -> pa.RecordBatch:
        """Batch (a, b) of what is held."""
        stars = [(u, v) for u, v in contract(self.edges).items() if u != v]
        self.edges = []
        return pa.record_batch([pa.array([s[k] for s in stars], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _hang(edges: DataFrame) -> DataFrame:
    """Edges (a, b) as (u, v) with u > v, once each, loops dropped."""
    return (
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _hang(both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return _hang(moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node at most, and none on a node that hangs itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.where("up > 1 OR up = 1 AND down = 1").isEmpty()


def roots_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node of each one's component) of the edges between ``a`` and ``b``."""
    nodes, at = np.unique(np.r_[a, b], return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[left], root[right]
        differ = x != y
        if not differ.any():
            return nodes, nodes[root]
        left, right, x, y = left[differ], right[differ], x[differ], y[differ]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) from all edges (a, b) at once."""
    ends: list[list[np.ndarray]] = [[], []]
    for batch in batches:
        for k in (0, 1):
            ends[k].append(batch.column(k).to_numpy(zero_copy_only=False))
    if ends[0]:
        yield pa.record_batch([pa.array(x, pa.int64()) for x in roots_of(*map(np.concatenate, ends))], names=["node", "root"])


def connected_components(edges: DataFrame, held: int = HELD_EDGES) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node of its component.

    Up to ``held`` edges are contracted in one task, without a shuffle.  More go
    through rounds of stars, until so few are left or all are stars.  Their
    number is logarithmic in a component's size, and smaller when tasks have
    given out their edges as ``Stars``; each round is written to the shared
    checkpoint folder, aggregations combine map-side and the joins on a popular
    node are ordinary joins that adaptive execution can split.  Null ends and
    loops are ignored; no edges give no rows.  ``edges`` is read twice.
    """

    def whole(links: DataFrame) -> DataFrame:
        return links.coalesce(1).mapInArrow(_held, "node long, root long")

    if edges.count() <= held:
        return whole(edges.where("a <> b").select("a", "b"))
    state = cut(_hang(edges))
    while True:
        if state.count() <= held:
            return whole(state)
        if _all_stars(state):
            break
        state = cut(_small_star(_large_star(state)))
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)

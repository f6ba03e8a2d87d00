"""Connected components of a graph given as edges, by randomized contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize

#: Edges, each counted from both ends, that one task puts together: what is left of a graph of any size.
REST = 1 << 16


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vertex of at most ``REST`` edges with the least one of its component."""
    root: dict[int, int] = {}
    for b in batches:
        for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True):
            for v in (x, y):
                root.setdefault(v, v)
            while root[x] != x:
                root[x] = x = root[root[x]]
            while root[y] != y:
                root[y] = y = root[root[y]]
            root[max(x, y)] = min(x, y)
    for v in sorted(root):  # a root is less than what it holds: that of the next one above is final
        root[v] = root[root[v]]
    yield pa.RecordBatch.from_arrays([pa.array(list(root), pa.int64()), pa.array(list(root.values()), pa.int64())], ["id", "to"])


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of each vertex of ``edges`` (a, b); a component is named by its least vertex.

    In each round a vertex joins the one that comes first among itself and its neighbours, in an order by a hash that is
    new in every round, and the edges between what has joined make the next round's graph.  Whatever the shape of the
    graph and the order of its ids, a round is expected to leave a fixed share of the vertices at most, so that rounds
    are logarithmic and all rounds together cost a few times the first.  The aggregate has a partial step: a vertex of
    very many edges is no single task's work.  The rounds end when ``REST`` edges are left, a number that does not depend
    on the graph: the last rounds would be many jobs for few edges.  At the end the rounds' choices are put together, last
    round first.
    """
    both = edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "edges")
    chosen: list[DataFrame] = []
    while (left := both.count()) > REST:
        order = lambda c, k=len(chosen): F.struct(F.xxhash64(c, F.lit(k)).alias("place"), F.col(c).alias("to"))
        first = both.groupBy("a").agg(F.least(F.min(order("b")), order("a")).alias("first"))
        to = materialize(first.select(F.col("a").alias("id"), "first.to"), "joined")
        chosen.append(to)
        ends = both.join(to.select(F.col("id").alias("a"), F.col("to").alias("x")), "a").join(to.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
        fewer = materialize(ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        discard(both)
        both = fewer
    if not left and not chosen:
        return both.select(F.col("a").alias("id"), F.col("b").alias("component"))
    if left:
        chosen.append(materialize(both.select(F.col("a").cast("long"), F.col("b").cast("long")).coalesce(1).mapInArrow(_rest, "id long, to long"), "rest"))
    discard(both)
    found = chosen.pop()
    for to in reversed(chosen):
        later = found.select(F.col("id").alias("to"), F.col("to").alias("last"))
        further = materialize(to.join(later, "to", "left").select("id", F.coalesce("last", "to").alias("to")), "components")
        discard(found)
        discard(to)
        found = further
    least = found.groupBy("to").agg(F.least(F.min("id"), F.col("to")).alias("component"))
    return materialize(found.join(least, "to").select("id", "component"), "components")

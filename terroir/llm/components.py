"""Connected components of an undirected graph of long ids, as joins and aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, settle, small

#: Bytes of per-node minima that may be broadcast; beyond it the joins shuffle.
BROADCAST_BYTES = 32 << 20
#: Edges that one step of a task contracts.
STEP_EDGES = 1 << 19


def forests(links: DataFrame) -> DataFrame:
    """(u, v), u > v: the links of each task (in steps of ``STEP_EDGES``) contracted to one star for each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent.get(x, x)
            return top

        def contracted() -> pa.RecordBatch:
            nodes = [x for x in parent if root(x) != x]
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["u", "v"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                one, other = root(a), root(b)
                parent[max(one, other)] = min(one, other)
            if len(parent) >= STEP_EDGES:
                yield contracted()
                parent.clear()
        if parent:
            yield contracted()

    return links.mapInArrow(run, "u long, v long")


def _minima(pairs: DataFrame, most: int) -> DataFrame:
    """For each u, of which there are ``most`` at most, the least of its neighbours v and itself."""
    found = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return small(settle(found, most), 64, BROADCAST_BYTES)


def stars(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b) that can reach a lesser one: component is the least of those.

    A node that isn't among them is the least of its component. Each task first contracts the links that it reads,
    about ``STEP_EDGES`` of them. Then large-star and small-star steps alternate (Kiveris et
    al., 2014) until every node hangs on the least node of its component; every step is written, so that a lost
    executor costs one step at most. A node with very many neighbours is only ever a join key, never a group held in
    one task. Links of a node with itself alone don't count.
    """
    plain = settle(links.select("a", "b"))
    edges = settle(forests(plain.coalesce(plain.count() // STEP_EDGES + 1)))
    discard(plain)
    while edges.select("u").join(edges.select(F.col("v").alias("u")), "u", "left_semi").limit(1).count() or edges.groupBy("u").count().where("count > 1").limit(1).count():
        most = 2 * edges.count()
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: neighbours above u go to the least neighbour
        grown = both.join(_minima(both, most), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        grown = settle(grown, most)
        # small star: neighbours below u, and u itself, go to the least neighbour
        least = _minima(grown, most)
        moved = grown.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = settle(moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), 2 * most)
        discard(edges)
        discard(grown)
        edges = after
    # each node hangs on one root, and roots on none: these are the components
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the least node that can be reached."""
    found = stars(links)
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())

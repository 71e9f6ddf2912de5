"""Connected components of a graph given as links, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farmledger.llm.scratch import keep


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the links of one task, each node with the smallest node it is connected to among them."""
    parent: dict[int, int] = {}

    def root(k: int) -> int:
        top = k
        while (above := parent.get(top, top)) != top:
            top = above
        while (above := parent.get(k, k)) != top and above != k:
            parent[k] = top
            k = above
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    for low in range(0, len(nodes), 50_000):
        part = nodes[low : low + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(k) for k in part], pa.int64())], ["u", "v"])


def connected_components(links: DataFrame, x: str, y: str) -> DataFrame:
    """(node, component): the smallest node of each node's component, for the nodes that have a link.

    Every step is an aggregate and a join on node, and its result is written once. Self-links and repeated links do no
    harm; a hub's links are not gathered, only their minimum. Before each round every task replaces the links it has by a
    forest with the same components, which shortens chains without a shuffle. The number of rounds grows with the logarithm
    of the longest chain.
    """
    edges = links.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).where("u <> v")
    edges = keep(edges.mapInArrow(_forest, "u long, v long"), "components")
    previous = None
    while True:
        # large star: neighbours above a node point to the smallest of its neighbourhood
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours point to the smallest of them
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pointed = small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        edges = keep(pointed.mapInArrow(_forest, "u long, v long"), "components")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == previous:
            break
        previous = state
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

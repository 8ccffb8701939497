"""Connected components of links, without collecting them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rushcart.sources.folders import stored

#: Links that one task joins at most, about.
PER_TASK = 500_000


def _smallest(edges: DataFrame) -> DataFrame:
    """Per node, the smallest of itself and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _forest(batches):
    """Links of a task joined to trees of depth one."""
    above: dict[int, int] = {}

    def top(x):
        while (up := above.setdefault(x, x)) != x:
            above[x] = x = above[up]
        return x

    for batch in batches:
        for u, v in zip(*(batch.column(c).to_pylist() for c in ("u", "v"))):
            a, b = top(u), top(v)
            if a != b:
                above[max(a, b)] = min(a, b)
    nodes = [x for x in above if above[x] != x]
    for a in range(0, len(nodes), 50_000):
        part = nodes[a : a + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([top(x) for x in part], pa.int64())], ["u", "v"])


def _joined(edges: DataFrame) -> DataFrame:
    edges = stored(edges, "edges")
    tasks = -(-edges.count() // PER_TASK)
    return stored(edges.coalesce(max(tasks, 1)).mapInArrow(_forest, "u long, v long"), "forest")


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for every node of links (a, b); the root is the smallest node of the component.

    Each task joins its links to trees of depth one. Where trees of several tasks meet, two
    steps that keep the components and shorten all paths bring them together: every larger
    neighbour, then every smaller one, is linked to the smallest node nearby; and so on until
    every node has one root that is no other's. Each round works on a written table, so a lost
    executor costs one round at most.
    """
    edges = _joined(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    for _ in range(rounds):
        unsettled = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
        meeting = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
        if unsettled.unionAll(meeting).isEmpty():
            break
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = _smallest(large)
        small = (
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u != v")
        )
        edges = _joined(small.distinct())
    else:
        raise RuntimeError("links did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

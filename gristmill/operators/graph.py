"""Grouping by graph structure (survey 2.J)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    Returns ``node, component`` (component: the smallest node reachable) for every node that
    has an edge; self loops give singletons, null ends are ignored. Each round is two
    group-minimums and two equi-joins, never a collected neighbour list, so a vertex with very
    many edges is a skewed join that adaptive execution splits. The edge set is written to the
    shared folder once a round. Rounds grow with the logarithm of the longest path.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    e = written(e.distinct(), "given")
    nodes = e.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    nodes = written(nodes, "nodes")
    e = written(e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _fingerprint(e)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low).where("u <> v").distinct()
        e = written(small, "edges")
        new = _fingerprint(e)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    root = e.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(root, nodes["node"] == root["u"], "left").select("node", F.coalesce("component", "node").alias("component"))


def _fingerprint(e: DataFrame) -> tuple:
    h: Column = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(e.agg(F.count(F.lit(1)), F.sum(h)).first())

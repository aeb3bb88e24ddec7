"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramloom.llm.common import forget, materialize, spread_join


def _stats(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (u, v: long); the component is its least node.

    A node's neighbours are never gathered: each round takes minima by a partial aggregate and joins them back, the rows
    of a hot node in parts. Every round is written to the shared folder, and rounds that were read are deleted.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    before = None
    for _ in range(rounds):
        state = _stats(now)
        if state == before or state[0] == 0:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u is not null")
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        # large star: every larger neighbour of u is linked to the least of u and its neighbours
        large = spread_join(both, least, "u", "n", total=2 * state[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "cc")
        forget(now)
        # small star: u and its smaller neighbours are linked to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        moved = spread_join(large, low, "u", "n", total=state[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = materialize(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        forget(large)
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    to = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return to.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

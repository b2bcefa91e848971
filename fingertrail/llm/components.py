"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fingertrail.session import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (the larger or the smaller ones) are tied to the smallest node around it.

    The smallest neighbour is a combinable minimum, so a hub costs its task only the joined rows, which
    adaptive execution splits.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    back = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    near = both.unionByName(back)
    lowest = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        moved = near.filter("v > u").join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        below = near.filter("v < u").join(lowest, "u")
        moved = below.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            lowest.filter("m < u").select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Columns node and component (its smallest node) for every node with an edge; edges are pairs of longs a, b."""
    state = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    seen = None
    while True:
        mark = state.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (mark["n"], mark["s"]) == seen:
            break
        seen = (mark["n"], mark["s"])
        state = store(_star(_star(state, True), False))
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

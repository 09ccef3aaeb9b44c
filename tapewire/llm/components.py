"""Connected components by alternating large and small stars, without a graph on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapewire.llm.common import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) of every id on an edge (a, b) of two different ids.

    A large star links all larger neighbours of a node to the smallest id around it,
    a small star does so with the smaller ones; the rounds grow with the logarithm
    of the longest chain. Each round is a written table, and so are the minima, so a
    node with very many edges is split by AQE. Loops, repeats and nulls are ignored.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = stage(edges.where("a <> b").select(low, high).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "minima")
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        smaller = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(smaller, "b")
        stars = small.select(F.col("m").alias("a"), "b").union(small.where("a <> m").select("m", "a"))
        edges = stage(stars.distinct(), "edges")
        state, before = _state(edges), state
        if state == before:
            break
    roots = edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).union(roots)

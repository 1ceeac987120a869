"""Connected components of an edge table, as Spark joins (alternating large and small stars).

Each round replaces the edges by stars around smaller nodes: first every node's larger neighbours, then its
smaller ones, are linked with the smallest node it sees. Components stay the same and end as stars around their
smallest node, after a number of rounds about the logarithm of the longest chain. Minima are combined map-side;
the join that spreads them is an ordinary shuffle join, whose large keys adaptive execution splits. Every
round is written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialise


def _smallest(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) and the smallest neighbour m of u, u itself included."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def _size(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of an edge; the component is its smallest node.

    Loops and repeated edges may occur; nulls may not. An empty table gives an empty result.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = materialise(edges, "edges")
    size = _size(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = materialise(large.distinct(), "edges")
        small = _smallest(large)
        edges = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = materialise(edges.where("u <> v").distinct(), "edges")
        then = _size(edges)
        if then == size:
            break
        size = then
    stars = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.union(centres)

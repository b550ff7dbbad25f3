"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import materialize

#: Edges of a graph, at most, that one task goes over: shuffling so few costs more than all else.
FEW = 1 << 14


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Large stars hang every larger neighbour on a node's smallest one, small stars every smaller
    one; after a number of rounds that grows with the logarithm of the nodes only stars are left.
    Edges with a null end and loops link nothing. Smallest neighbours are merged before the
    shuffle and the joins are plain, so that the planner can split a node with many neighbours.
    What is left of a graph with ``FEW`` edges or fewer is one partition, whose rounds need no shuffle.
    """
    u, v = F.col(f"`{a}`"), F.col(f"`{b}`")
    edges = edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    edges = materialize(edges, "edges")
    seen = _fingerprint(edges)
    while seen[0]:
        dealt = (lambda df: df.coalesce(1)) if seen[0] <= FEW else (lambda df: df)
        edges = dealt(edges)
        ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
        both = edges.select(F.inline(ways))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(parent, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(dealt(small.union(parent.select("u", F.col("m").alias("v")))).distinct(), "edges")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))

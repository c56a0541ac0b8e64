"""Connected components of a distributed edge list (distributed union-find).

Alternates the two star operations of Kiveris et al., "Connected Components in
MapReduce and Beyond": every round moves edges to smaller neighbours until
each component is a star around its smallest node. Only DataFrame operations;
minima are pre-aggregated, so a node with very many edges is no single task's
work, and the joins on such a node can be split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # (v, smallest neighbour of u) for every neighbour v > u
    return both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("m").alias("a"), "b")


def _small_star(e: DataFrame) -> DataFrame:
    """``e`` has a < b: every b's neighbours below it move to the smallest."""
    low = e.groupBy("b").agg(F.min("a").alias("m"))
    moved = e.join(low, "b").where(F.col("a") > F.col("m")).select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(low.select(F.col("m").alias("a"), "b"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has an edge to another node; root
    is the component's smallest node. Loops, repeated edges and nulls count
    for nothing; without edges the result is empty. Each round is cut with a
    reliable checkpoint."""
    e = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"),
                     (F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).alias("ok"))
    e = cut_lineage(e.where("ok").select("a", "b").distinct())

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())

    seen = state(e)
    while seen[0]:
        e = cut_lineage(_small_star(_large_star(e).distinct()).distinct())
        now = state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())

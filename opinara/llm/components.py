"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b: long); the component is its smallest node.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest one, then
    its smaller neighbours. Each round reduces with partial aggregates, so a node with very many neighbours is
    no burden for one task. The edge tables of the rounds are stored, so a lost executor costs one round at most.
    """
    pairs = stored(_distinct(edges))
    while True:
        mirrored = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = mirrored.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _distinct(mirrored.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b"))
        small = large.groupBy("b").agg(F.min("a").alias("m"))
        after = stored(_distinct(large.join(small, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
                                 .union(small.select(F.col("m").alias("a"), "b"))))
        if _sum(after) == _sum(pairs):
            break
        pairs = after
    return (pairs.select(F.col("b").alias("node"), F.col("a").alias("component"))
            .union(pairs.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct())


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _sum(edges: DataFrame) -> tuple:
    """Edge count and two sums of their hashes: equal for equal tables."""
    return tuple(edges.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                              F.sum(F.hash("b", "a").cast("long"))).first())

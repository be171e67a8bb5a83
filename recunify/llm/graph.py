"""Connected components of a large edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recunify.llm.store import split_join


def components(edges: DataFrame, stage, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component.

    Every round points the larger neighbours of a node, then all of its
    smaller ones, at its smallest neighbour; rounds grow with the logarithm
    of the longest chain.  Each round is written by ``stage`` (which cuts the
    lineage) and stops when the edges, compared by count and hash sum, stay.
    Links never come to the driver.
    """
    now = stage(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                .filter(F.col("a") != F.col("b")).distinct())
    mark = None
    while mark != (mark := _mark(now)) and mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (split_join(both, _smallest(both), "a").filter(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter(F.col("a") != F.col("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = split_join(large, low, "a")
        now = stage(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .unionByName(low.select("a", F.col("m").alias("b")))
                    .filter(F.col("a") != F.col("b")).distinct())
    return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))


def _smallest(both: DataFrame) -> DataFrame:
    return both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]

"""Connected components of links, by alternating star steps over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnhouse.llm.common import Stored


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest neighbour or itself."""
    near = both_ways(edges)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = near.join(least, "a").where("b > a")
    return moved.select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them; edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b")
    own = least.select(F.col("m").alias("a"), "b")
    return moved.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a <> b").unionByName(own).distinct()


def fingerprint(edges: DataFrame) -> tuple:
    sums = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(sums)


def components(links: DataFrame) -> Stored:
    """node and component, the smallest node reachable, of every node in a link.

    ``links`` has columns a and b. Each step is written, so a lost executor costs one step; the
    number of steps grows with the logarithm of the longest path.
    """
    ordered = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    current = Stored(ordered, "links")
    before = fingerprint(current.df)
    while before[0]:
        following = Stored(small_star(large_star(current.df)), "links")
        after = fingerprint(following.df)
        current.remove()
        current = following
        if after == before:
            break
        before = after
    edges = current.df
    labels = edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
    stored = Stored(labels, "components")
    current.remove()
    return stored

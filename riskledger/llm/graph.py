"""Connected components of a link table by alternating star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger.llm.shared import Scratch


def _downward(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def _unfinished(links: DataFrame) -> bool:
    """Whether some node hangs on two nodes, or on one that hangs on another."""
    twice = links.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u")
    chained = links.select("v").join(links.select(F.col("u").alias("v")), "v", "left_semi")
    return bool(twice.union(chained).take(1))


def components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """node and comp (smallest node reachable) of every node that has a link to another node.

    Every step hangs the neighbours of a node on the smallest of them; smallest values are taken before
    the shuffle, so a node with very many links costs no more than its links.  Steps are written to the
    shared folder and end when every node hangs on the smallest of its component.
    """
    current = scratch.stage(links.filter(F.col(a) != F.col(b)).select(*_downward(a, b)).distinct(), "links")
    while _unfinished(current):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lowest, "u").filter("v != m").select(*_downward("v", "m"))
        current = scratch.stage(moved.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return stars.union(current.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())

"""Connected components of a distributed list of links, by alternating star operations.

Large star ties every larger neighbour of a node to the smallest node around it; small star does the same
with the smaller ones. The number of rounds is logarithmic; each round is written to the shared folder.
Nothing but counts goes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored


def _sum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).hint("merge")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v): the smallest node that it reaches.

    Null ends and loops are left out; an empty list has no node.
    """
    now = stored(links.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).where("u <> v").distinct(), "links")
    seen = _sum(now)
    while seen[0]:
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        now = stored(small.where("u <> v").distinct(), "links")
        if (new := _sum(now)) == seen:
            break
        seen = new
    heads = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(heads).hint("merge")

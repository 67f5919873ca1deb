"""Connected components of a link table by alternating stars.

Links are rows, never objects of the driver. One round hangs every node's larger neighbours on its smallest
neighbour and then every node and its smaller neighbours on the smallest of them; each round at least keeps and
mostly halves the distance to the smallest node. Every round is stored, so a lost executor repeats tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import settle


def _star(links: DataFrame, center: str, leaf: str) -> DataFrame:
    """Each leaf of ``links`` beside the smallest node of its center's star."""
    least = links.groupBy(F.col(center).alias("_center")).agg(F.min(leaf).alias("_least"))
    least = least.withColumn("_least", F.least("_center", "_least"))
    return links.join(least, links[center] == least["_center"])


def _large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    starred = _star(both, "high", "low").where(F.col("low") > F.col("high"))
    return starred.select(F.col("low").alias("high"), F.col("_least").alias("low")).distinct()


def _small(links: DataFrame) -> DataFrame:
    starred = _star(links, "high", "low")
    leaves = starred.select(F.col("low").alias("high"), F.col("_least").alias("low"))
    centers = starred.select("high", F.col("_least").alias("low"))
    return leaves.unionByName(centers).where(F.col("high") != F.col("low")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of ``links(low, high)``.

    Links may repeat and stand in either direction; a link of a node to itself and links with a null are left
    out. Nodes without a link are not returned. Empty links give an empty result.
    """
    links = settle(links.where("low <> high").select(F.greatest("low", "high").alias("high"),
                                                     F.least("low", "high").alias("low")).distinct(), "links")
    mark = None
    while True:
        links = settle(_small(_large(links)), "links")
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first()
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return links.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(roots)

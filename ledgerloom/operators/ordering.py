"""Places in a total order without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import settle


# Keys looked up by broadcast, with a number each; beyond that there are too many for one of them to be so large.
MOST_BROADCAST_KEYS = 100_000


def ranked(df: DataFrame, order: Sequence[str | Column], name: str, label: str) -> DataFrame:
    """``df`` stored with the gapless place (from 0) of each row in the given order.

    Rows are dealt by range and sorted in place; a row's number in its partition and the sizes of the partitions
    before it (one number a partition on the driver) make its place, so no task sees more than a partition.
    """
    stored = settle(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("__at", F.monotonically_increasing_id()), label)
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(stored.groupBy(part.alias("part")).count().collect())
    starts, total = [], 0
    for number, size in sizes:
        starts.append((number, total))
        total += size
    before = df.sparkSession.createDataFrame(starts, "__part long, __before long")
    return (stored.join(F.broadcast(before), part == F.col("__part"))
            .withColumn(name, place + F.col("__before")).drop("__at", "__part", "__before"))


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, label: str) -> DataFrame:
    """``df`` with the place (from 1) of each row among the rows of its key; for keys with very many rows."""
    placed = ranked(df, [*keys, *order], "__place", label)
    first = settle(placed.groupBy(*keys).agg(F.min("__place").alias("__first")), f"{label}_first")
    if first.count() <= MOST_BROADCAST_KEYS:
        first = F.broadcast(first)  # else the very key that is split would be one task of the join
    return placed.join(first, list(keys)).withColumn(name, F.col("__place") - F.col("__first") + 1).drop("__place", "__first")

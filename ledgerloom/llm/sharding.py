"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and given their fractional rank there; in the order of
fractional ranks every stretch holds the sources in their overall proportion, so cutting it into equal stretches
gives shards that all match the mixture. Both orders are made by range partitioning and places are put together
from partition sizes, so a source with a third of all rows is many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ordering import ranked
from ledgerloom.sources.workspace import settle

SHARDS = 16
SEED = 20_240_917
# Sources are looked up by broadcast up to this many (under 100 bytes each), by shuffle beyond.
BROADCAST_SOURCES = 100_000


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row.

    ``size`` is the bytes of the text plus one, a null text having none. Row counts of shards differ by one at
    most, and so, up to rounding, do the counts of a source in any two shards. Slots are gapless from 0. A null
    source is a source of its own; rows equal in id, source and text are interchangeable; an empty table has no
    rows. Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                       (F.octet_length(text) + F.lit(1).cast("long")).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("_draw", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"))
    by_source = ranked(rows, [F.col(c) for c in ("source", "_draw", "doc_id", "text_crc32", "size")], "_place",
                       "by_source")
    sources = settle(by_source.groupBy(F.col("source").alias("_source"))
                     .agg(F.min("_place").alias("_first"), F.count("*").alias("_rows")), "sources")
    if sources.count() <= BROADCAST_SOURCES:
        sources = F.broadcast(sources)
    rank = F.col("_place") - F.col("_first")
    fractions = (by_source.join(sources, F.col("source").eqNullSafe(F.col("_source")))
                 .withColumn("_fraction", (2 * rank + 1) / (2 * F.col("_rows")))
                 .withColumn("_tie", F.xxhash64(F.lit(seed), "source"))
                 .drop("_place", "_first", "_rows", "_source"))
    mixed = ranked(fractions, [F.col(c) for c in ("_fraction", "_tie", "source", "_draw", "doc_id", "text_crc32", "size")],
                   "_place", "mixed")
    total = mixed.count()
    shard = F.expr(f"_place * {shards} div {max(total, 1)}")
    return mixed.select("doc_id", "source", "size", "text_crc32", shard.cast("int").alias("shard"),
                        (F.col("_place") - F.expr(f"(_place * {shards} div {max(total, 1)} * {total} + {shards - 1}) "
                                                  f"div {shards}")).alias("slot"))

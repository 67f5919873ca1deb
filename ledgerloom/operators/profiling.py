"""Questions asked of a new export before it is trusted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and the largest number of rows under one key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), F.max("n").alias("most_rows_per_key"))


def column_profile(df: DataFrame) -> DataFrame:
    """A row for each column: rows, nulls, blanks, shortest and longest text, smallest and largest one.

    Values are taken as text. All columns are measured by one aggregate over one scan, which combines in the tasks and
    leaves a single row; that row is then unfolded. An empty relation has a row for each column too.
    """
    measured, entries = [], []
    for at, name in enumerate(df.columns):
        value = F.col(f"c{at}")
        stats = {"n_null": F.count_if(value.isNull()), "n_blank": F.count_if(F.trim(value) == ""),
                 "shortest": F.min(F.length(value)), "longest": F.max(F.length(value)),
                 "smallest": F.min(value), "largest": F.max(value)}
        measured += [stat.alias(f"{label}{at}") for label, stat in stats.items()]
        entries.append(F.struct(F.lit(name).alias("column_name"), F.col("n_rows"),
                                *[F.col(f"{label}{at}").alias(label) for label in stats]))
    texts = df.toDF(*[f"c{at}" for at in range(len(df.columns))])
    texts = texts.select(*[F.col(c).cast("string").alias(c) for c in texts.columns])
    return texts.agg(F.count("*").alias("n_rows"), *measured).select(F.inline(F.array(*entries)))


def lifecycle_sets(df: DataFrame, key: str, state: str) -> DataFrame:
    """Which sets of states occur together under one key, and how often.

    The rows are reduced to distinct (key, state) pairs first, so a set is as small as the state
    vocabulary however many rows a key has.
    """
    states = (df.select(key, state).distinct().groupBy(key)
              .agg(F.array_join(F.sort_array(F.collect_set(state)), "+").alias("states")))
    return states.groupBy("states").agg(F.count("*").alias("n_keys"))


def vocabulary_crosstab(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows"))


def rates_by(df: DataFrame, by: str, **conditions: Column) -> DataFrame:
    """Per group: rows, rows meeting each condition, and their share in basis points."""
    counted = df.groupBy(by).agg(
        F.count("*").alias("n_rows"), *[F.count_if(c).alias(f"n_{name}") for name, c in conditions.items()])
    for name in conditions:
        counted = counted.withColumn(
            f"{name}_bp", F.floor((F.col(f"n_{name}") * 20000 + F.col("n_rows")) / (F.col("n_rows") * 2)))
    return counted


def sequence_gaps(df: DataFrame, number: str, block: int = 1_000_000) -> DataFrame:
    """Runs of missing numbers between the smallest and the largest one present.

    Numbers are put in order within blocks, in parallel. A block is then one span from its first to
    its last number, and the spans are put in order within blocks of blocks. What is left for one task
    is at most a span per ``block`` squared numbers of the range.
    """
    numbers = df.select(F.col(number).cast("bigint").alias("first")).filter("first is not null").distinct()
    spans = numbers.withColumn("last", F.col("first"))
    steps = []
    for width in (block, block * block):
        placed = spans.withColumn("b", F.expr(f"(first - pmod(first, {width})) div {width}"))
        ordered = Window.partitionBy("b").orderBy("first")
        steps.append(placed.select(F.lag("last").over(ordered).alias("before"), F.col("first").alias("after")))
        spans = placed.groupBy("b").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("b")
    steps.append(spans.select(F.lag("last").over(Window.orderBy("first")).alias("before"), F.col("first").alias("after")))
    gaps = steps[0].unionByName(steps[1]).unionByName(steps[2])
    return gaps.filter("after - before > 1").select(
        (F.col("before") + 1).alias("first_missing"), (F.col("after") - 1).alias("last_missing"),
        (F.col("after") - F.col("before") - 1).alias("n_missing"))


def calendar_holes(df: DataFrame, day: str, by: str | None = None) -> DataFrame:
    """Weekdays without a row between the first and the last date, per group if one is named."""
    keys = [by] if by else []
    present = df.select(*keys, F.col(day).cast("date").alias("day")).distinct()
    span = present.groupBy(*keys).agg(F.min("day").alias("a"), F.max("day").alias("z"))
    days = (span.select(*keys, F.explode(F.sequence("a", "z")).alias("day"))
            .filter(~F.dayofweek("day").isin(1, 7)))
    return days.join(present, [*keys, "day"], "left_anti")


def value_range(df: DataFrame, by: str, value: str) -> DataFrame:
    """Low, high and spread (basis points of the low) per group."""
    spread = F.floor((F.col("high") - F.col("low")) * 10000 / F.col("low"))
    return (df.groupBy(by).agg(F.count("*").alias("n_rows"), F.min(value).alias("low"), F.max(value).alias("high"))
            .withColumn("spread_bp", spread.cast("bigint")))


def coverage(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many distinct keys occur on both sides or on one only."""
    tagged = (left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r"))
              .unionByName(right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
              .dropna(subset=list(keys)))
    sides = tagged.groupBy(*keys).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return sides.agg(
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("in_both"),
        F.count_if(F.col("r") == 0).alias("left_only"),
        F.count_if(F.col("l") == 0).alias("right_only"))

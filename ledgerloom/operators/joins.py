"""Join helpers that keep rows without a key, and oversized reference sides, from piling up."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.ordering import numbered

_SPREAD = "__spread"


def _spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A 64-bit leading key: the hash of the join keys, or of the whole row where a key is null.

    A row with a null key matches nothing, wherever it sits; without this all of them would hash to
    one partition. For the others the number settles nearly every comparison of the sort.
    """
    keyless = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    of_row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.withColumn(_SPREAD, F.when(keyless, of_row).otherwise(F.xxhash64(*keys)))


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` (same name on both sides) with rows of null key spread over all tasks."""
    joined = _spread(left, keys).join(_spread(right, keys), [_SPREAD, *keys], how)
    return joined.drop(_SPREAD)


def paired_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_order: Sequence[str],
                right_order: Sequence[str], hot: bool = False) -> DataFrame:
    """Full outer join that pairs the k-th rows of a repeated key; rows of null key stay alone.

    Both sides are stacked and shuffled once, by key. There each row gets its number within its key and side, and the
    two rows of a number stand next to each other: no join, so a key with n and m rows costs their sum and not their
    product. ``hot`` is for few keys with very many rows each: their numbers come from range partitions and are join
    keys.
    """
    if hot:
        ours = numbered(left, keys, left_order, "__nth", "hot_left")
        theirs = numbered(right, keys, right_order, "__nth", "hot_right")
        return ours.join(theirs, [*keys, "__nth"], "full_outer").drop("__nth")

    def side(df: DataFrame, number: int, name: str, order: Sequence[str]) -> DataFrame:
        keyless = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
        rest = [F.col(f"`{c}`") for c in df.columns if c not in keys]
        return _spread(df, keys).select(
            _SPREAD, *keys, F.lit(number).alias("__side"), F.when(keyless, number).alias("__lone"),
            *[F.col(f"`{c}`").alias(f"__{name}_order_{k}") for k, c in enumerate(order)], F.struct(*rest).alias(f"__{name}"))

    both = side(left, 0, "left", left_order).unionByName(side(right, 1, "right", right_order), allowMissingColumns=True)
    order = [f"__{name}_order_{k}" for name, given in (("left", left_order), ("right", right_order)) for k in range(len(given))]
    # All windows cluster by the spread key, so the shuffle by it alone serves them.
    group = [_SPREAD, *keys, "__lone"]
    numbered_rows = both.repartition(_SPREAD).withColumn(
        "__nth", F.row_number().over(Window.partitionBy(*group, "__side").orderBy(*order))).drop(*order)
    pair = Window.partitionBy(*group, "__nth").orderBy("__side")
    met = numbered_rows.withColumns({"__partner": F.lead("__right").over(pair), "__taken": F.lag("__side").over(pair).isNotNull()})
    theirs = F.coalesce("__right", "__partner")
    return (met.filter(~F.col("__taken")).select(
        *keys, *[F.col(f"__left.`{c}`").alias(c) for c in left.columns if c not in keys],
        *[theirs[c].alias(c) for c in right.columns if c not in keys]))

"""Several export rows about one payment become one row, without losing money or fanning out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import MONEY
from ledgerloom.functions import money
from ledgerloom.operators.joins import keyed_join


def collapse_copies(df: DataFrame) -> DataFrame:
    """Byte-identical rows to one row with ``n_copies``.

    One grouping over all columns: copies already merge on the map side, so even a row repeated
    millions of times costs one entry per task. Rows that differ anywhere stay separate.
    """
    return df.groupBy(*df.columns).agg(F.count("*").alias("n_copies"))


def surplus_of(amount: Column, n_copies: Column) -> Column:
    """Money the extra copies would have added; null where there are none."""
    return F.when(n_copies > 1, (amount * (n_copies - 1)).cast(MONEY))


def attach_summary(rows: DataFrame, details: DataFrame, keys: Sequence[str], **summaries: Column) -> DataFrame:
    """Left join ``rows`` to one aggregated line of ``details`` per key.

    The detail side is reduced to a row per key before it meets ``rows``, so the join never fans
    out, and a key with very many rows stays splittable by the adaptive skew join.
    """
    line = details.groupBy(*keys).agg(*[c.alias(name) for name, c in summaries.items()])
    return keyed_join(rows, line, keys, "left")


def split_fee_sum(commission: Column, markup: Column) -> Column:
    return (money.or_zero(commission) + money.or_zero(markup)).cast(MONEY)

"""As-of lookups: the last reference row on or before a date.

The reference side is turned into validity intervals once (``lead`` per key). A daily reference is
laid out as one row per key and day, which makes the lookup a plain equi-join; a sparse one (a few
rows per key) is joined on its key with the interval as a condition. Either way a row finds at most
one partner, so the grain cannot change. The measured reference side is broadcast; past the bound
the same equi-join shuffles on (key, day, salt), where the salt splits a currency that holds a large
part of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.config import RunConfig

_DAY, _SALT = "__day", "__salt"


@dataclass(frozen=True)
class DailyReference:
    """A reference laid out per key and day, with what was measured about it.

    ``days`` holds ``keys``, ``__day``, ``effective`` (the row's own date) and the value columns.
    Days after ``last_day`` read as ``last_day``: the newest row stays in force.
    """

    days: DataFrame
    keys: tuple[str, ...]
    effective: str
    last_day: object
    n_days: int


def daily(reference: DataFrame, keys: Sequence[str], effective: str) -> DailyReference:
    """Fill the gaps between publications. Expects a stored (or otherwise cheap) reference with one
    row per key and date: it is measured here, in one aggregate, before it is used."""
    size = reference.agg(F.max(effective).alias("last_day")).first()
    last_day = size["last_day"]
    by_key = Window.partitionBy(*keys).orderBy(effective)
    until = F.coalesce(F.date_sub(F.lead(effective).over(by_key), 1), F.lit(last_day).cast("date"))
    spans = reference.withColumn("__until", until)
    n_days = spans.agg(
        F.coalesce(F.sum(F.datediff("__until", effective) + 1), F.lit(0)).alias("n")).first()["n"]
    days = (spans
            .withColumn(_DAY, F.explode(F.sequence(effective, "__until")))
            .drop("__until"))
    return DailyReference(days, tuple(keys), effective, last_day, n_days)


def asof_daily(
    left: DataFrame,
    ref: DailyReference,
    on: Mapping[str, str],
    day: Column,
    take: Mapping[str, str],
    config: RunConfig = RunConfig(),
) -> DataFrame:
    """Left as-of join: attach ``take`` (reference column -> new name) in force on ``day``.

    ``on`` maps reference key -> left column. Rows before the first publication, and rows without a day, get nulls.
    """
    if ref.last_day is None:
        return left.withColumns({
            new: F.lit(None).cast(ref.days.schema[old].dataType) for old, new in take.items()})
    last = F.lit(ref.last_day).cast("date")
    capped = F.when(day > last, last).otherwise(day)  # least() would give a row without a date the last rate
    right = ref.days.select(
        *[F.col(k).alias(f"__r_{k}") for k in ref.keys], F.col(_DAY),
        *[F.col(old).alias(new) for old, new in take.items()])
    probe = left.withColumn("__asof", capped)
    condition = F.col("__asof") == F.col(_DAY)
    for key in ref.keys:
        condition = condition & (F.col(on[key]) == F.col(f"__r_{key}"))
    if ref.n_days <= config.max_broadcast_rows:
        right = F.broadcast(right)
    else:
        probe, right, condition = _salted(probe, right, condition, left.columns, config.asof_salts)
    drop = ["__asof", _DAY, _SALT, "__r_salt", *[f"__r_{k}" for k in ref.keys]]
    return probe.join(right, condition, "left").drop(*drop)


def _salted(probe, right, condition, columns, salts):
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (probe.withColumn(_SALT, salt),
            right.withColumn("__r_salt", copies),
            condition & (F.col(_SALT) == F.col("__r_salt")))


@dataclass(frozen=True)
class SparseReference:
    """Effective-dated rows, few per key, as half-open intervals [effective, __next)."""

    spans: DataFrame
    keys: tuple[str, ...]
    effective: str
    n_rows: int


def effective_dated(reference: DataFrame, keys: Sequence[str], effective: str) -> SparseReference:
    by_key = Window.partitionBy(*keys).orderBy(effective)
    spans = reference.withColumn("__next", F.lead(effective).over(by_key))
    return SparseReference(spans, tuple(keys), effective, reference.count())


def asof_effective(
    left: DataFrame,
    ref: SparseReference,
    on: Mapping[str, str],
    day: Column,
    take: Mapping[str, str],
    config: RunConfig = RunConfig(),
) -> DataFrame:
    """Left join to the latest row with effective date <= ``day`` for the same key."""
    right = ref.spans.select(
        *[F.col(k).alias(f"__r_{k}") for k in ref.keys],
        F.col(ref.effective).alias("__from"), "__next",
        *[F.col(old).alias(new) for old, new in take.items()])
    probe = left.withColumn("__asof", day)
    condition = (F.col("__asof") >= F.col("__from")) & (
        F.col("__next").isNull() | (F.col("__asof") < F.col("__next")))
    for key in ref.keys:
        condition = condition & (F.col(on[key]) == F.col(f"__r_{key}"))
    if ref.n_rows <= config.max_broadcast_rows:
        right = F.broadcast(right)
    else:
        probe, right, condition = _salted(probe, right, condition, left.columns, config.asof_salts)
    drop = ["__asof", "__from", "__next", _SALT, "__r_salt", *[f"__r_{k}" for k in ref.keys]]
    return probe.join(right, condition, "left").drop(*drop)

"""Exchange rates and fee contracts: typing, versioning, lookup layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.config import MONEY, PERCENT, RATE
from ledgerloom.functions import text, time
from ledgerloom.operators.asof import DailyReference, SparseReference, daily, effective_dated


def rate_versions(raw: DataFrame) -> DataFrame:
    """Rank republications of one (date, currency); the newest is the current rate.

    Equal publication times are ordered by rate so the ranking is repeatable.
    """
    typed = raw.select(
        F.col("rate_date").cast("date").alias("rate_date"),
        "currency",
        F.col("usd_rate").cast(RATE).alias("usd_rate"),
        time.utc(F.col("published_at")).alias("published_at"))
    same_rate = Window.partitionBy("rate_date", "currency")
    oldest_first = same_rate.orderBy("published_at", "usd_rate")
    return (typed
            .withColumn("rate_version", F.row_number().over(oldest_first))
            .withColumn("is_current_rate", F.col("rate_version") == F.count("*").over(same_rate)))


def current_rates(versions: DataFrame) -> DataFrame:
    return versions.filter("is_current_rate").select("rate_date", "currency", "usd_rate")


def rate_calendar(current: DataFrame) -> DailyReference:
    return daily(current, ["currency"], "rate_date")


def fee_contracts(raw: DataFrame) -> DataFrame:
    return raw.select(
        "psp",
        F.col("account").alias("psp_account"),
        F.col("valid_from").cast("date").alias("valid_from"),
        F.col("percent_fee").cast(PERCENT).alias("percent_fee"),
        F.col("fixed_fee").cast(MONEY).alias("fixed_fee"),
        text.blank_to_null(F.col("fixed_fee_currency")).alias("fixed_fee_currency"))


def contract_spans(contracts: DataFrame) -> SparseReference:
    return effective_dated(contracts, ["psp", "psp_account"], "valid_from")

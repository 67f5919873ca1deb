"""Both sides priced in USD by one rule: the last current rate on or before the transaction date."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import MONEY, RATE, RunConfig
from ledgerloom.functions import money, time
from ledgerloom.operators.asof import DailyReference, SparseReference, asof_daily, asof_effective


def _usd_is_one(rate: Column) -> Column:
    return F.when(F.col("currency") == "USD", F.lit(Decimal("1")).cast(RATE)).otherwise(rate)


def published_rate(ledger: DataFrame, rates: DailyReference, config: RunConfig = RunConfig()) -> DataFrame:
    """Rate published for exactly the date booked; null where nothing was published that day."""
    found = asof_daily(
        ledger, rates, {"currency": "currency"}, F.col("fx_date_applied"),
        {"rate_date": "__published_on", "usd_rate": "__published"}, config)
    exact = F.when(F.col("__published_on") == F.col("fx_date_applied"), F.col("__published"))
    return (found.withColumn("fx_rate_published", _usd_is_one(exact))
            .drop("__published_on", "__published"))


def expected_rate(ledger: DataFrame, rates: DailyReference, config: RunConfig = RunConfig()) -> DataFrame:
    found = asof_daily(
        ledger, rates, {"currency": "currency"}, time.day_of(F.col("created_at_utc")),
        {"rate_date": "fx_date_expected", "usd_rate": "__expected"}, config)
    return (found.withColumn("fx_rate_expected", _usd_is_one(F.col("__expected")))
            .drop("__expected"))


def fx_fault() -> Column:
    """First fault that applies. Needs both the published and the expected rate."""
    return (F.when(F.col("currency") == "USD", "none")
            .when(F.col("fx_rate_published").isNull(), "fx_rate_unpublished")
            .when(F.col("fx_rate_applied") == 1, "fx_not_applied")
            .when(F.col("fx_rate_applied") != F.col("fx_rate_published"), "fx_rate_mismatch")
            .when(F.col("fx_date_applied") != F.col("fx_date_expected"), "fx_date_stale")
            .otherwise("none"))


def restate_ledger(ledger: DataFrame, rates: DailyReference, config: RunConfig = RunConfig()) -> DataFrame:
    """Ledger with its booking fault named and a restated USD beside the booked one, never over it."""
    looked_up = expected_rate(published_rate(ledger, rates, config), rates, config)
    restated = F.coalesce(money.convert(F.col("amount_local"), F.col("fx_rate_expected")), F.col("amount_usd"))
    return (looked_up
            .withColumn("fx_variance_reason", fx_fault())
            .withColumn("amount_usd_recon", restated)
            .withColumnRenamed("amount_usd", "amount_usd_engine")
            .withColumn("fx_correction_usd",
                        (F.col("amount_usd_engine") - F.col("amount_usd_recon")).cast(MONEY)))


def price_providers(conformed: DataFrame, rates: DailyReference, config: RunConfig = RunConfig()) -> DataFrame:
    found = asof_daily(
        conformed, rates, {"currency": "currency"}, time.day_of(F.col("created_at_utc")),
        {"usd_rate": "__rate"}, config)
    priced = found.withColumn("fx_rate_recon", _usd_is_one(F.col("__rate"))).drop("__rate")
    usd = {out: money.convert(F.col(local), F.col("fx_rate_recon")) for out, local in {
        "amount_usd": "amount_local",
        "amount_usd_settled": "amount_local_settled",
        "amount_usd_duplicate": "amount_local_duplicate"}.items()}
    fee = F.coalesce(F.col("fee_usd_native"), money.convert(F.col("fee_local"), F.col("fx_rate_recon")))
    recognised = F.coalesce("settled_at_utc", "created_at_utc")
    return priced.withColumns({**usd, "fee_usd": fee, "recognised_at_utc": recognised})


def apply_contracts(priced: DataFrame, contracts: SparseReference, config: RunConfig = RunConfig()) -> DataFrame:
    """Fee the contract in force allows, on settled sales with a contract only."""
    found = asof_effective(
        priced, contracts, {"psp": "psp", "psp_account": "psp_account"},
        time.day_of(F.col("recognised_at_utc")),
        {c: c for c in ("percent_fee", "fixed_fee", "fixed_fee_currency")}, config)
    due = ((F.col("operation_type") == "sale") & (F.col("status") == "settled")
           & F.col("percent_fee").isNotNull())
    fixed_currency = F.col("fixed_fee_currency")
    fixed_local = F.when(
        fixed_currency.isNull() | (fixed_currency == F.col("currency")), F.col("fixed_fee")
    ).otherwise(money.zero())
    # a fixed fee in USD also belongs in the fee of a provider that charges in USD
    fixed_usd = F.when(fixed_currency == "USD", F.col("fixed_fee")).otherwise(money.zero())
    local = money.percent_of(F.col("amount_local_settled"), F.col("percent_fee")) + fixed_local
    native = money.percent_of(F.col("amount_usd_settled"), F.col("percent_fee")) + fixed_usd
    return (found
            .withColumn("fee_local_contracted", F.when(due, local).cast(MONEY))
            .withColumn("fee_usd_contracted", F.when(
                due & F.col("fee_usd_native").isNotNull(), native.cast(MONEY)).otherwise(
                money.convert(F.col("fee_local_contracted"), F.col("fx_rate_recon")))))

"""Ledger against providers: signing, match keys, the two-sided match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import RunConfig
from ledgerloom.functions import money, text, time
from ledgerloom.operators.joins import paired_join

MATCH_KEYS = ["psp", "match_key", "operation_type"]

_LEDGER_COLUMNS = {
    "status": "engine_status", "currency": "engine_currency",
    "amount_local": "engine_amount_local", "amount_local_settled": "engine_amount_local_settled",
    "amount_usd_settled": "engine_amount_usd_settled", "amount_usd_booked": "engine_amount_usd_booked",
    "fx_variance_reason": "engine_fx_variance_reason", "fx_correction_usd": "engine_fx_correction_usd",
    "recognised_at_utc": "engine_recognised_at_utc"}
_PROVIDER_COLUMNS = {
    "order_ref": "psp_order_ref", "status": "psp_status", "currency": "psp_currency",
    "amount_local": "psp_amount_local", "amount_local_settled": "psp_amount_local_settled",
    "amount_local_authorised": "psp_amount_local_authorised",
    "amount_usd_settled": "psp_amount_usd_settled", "amount_local_duplicate": "psp_amount_local_duplicate",
    "amount_usd_duplicate": "psp_amount_usd_duplicate", "fee_local": "psp_fee_local",
    "fee_usd": "psp_fee_usd", "fx_rate_recon": "psp_fx_rate_recon",
    "recognised_at_utc": "psp_recognised_at_utc"}
_PROVIDER_AS_IS = ("psp_account", "psp_reference", "fee_local_contracted", "fee_usd_contracted",
                   "percent_fee", "fixed_fee", "fixed_fee_currency", "batch_number")


def ledger_match_key() -> Column:
    """Order reference, or the capture second with product and country where no reference exists."""
    keyed_by_time = F.col("psp") == "google_play"
    return F.when(keyed_by_time, text.composite_key(
        F.col("captured_at_utc"), F.col("sku"), F.col("country"))).otherwise(F.col("order_id"))


def signed_ledger(restated: DataFrame) -> DataFrame:
    """Reversals negative, anything not settled worth zero, recognition at capture or else creation."""
    sale = F.lower("operation_type") == "sale"

    def signed(column: str) -> Column:
        return F.when(sale, F.col(column)).otherwise(-F.col(column))

    def moved(column: str) -> Column:
        return F.when(F.col("status") != "settled", money.zero()).otherwise(signed(column))

    return restated.select(
        "txn_id", "order_id", ledger_match_key().alias("match_key"), "psp", "psp_reference",
        F.lower("operation_type").alias("operation_type"), "status", "sku", "country", "currency",
        signed("amount_local").alias("amount_local"),
        moved("amount_local").alias("amount_local_settled"),
        moved("amount_usd_recon").alias("amount_usd_settled"),
        moved("amount_usd_engine").alias("amount_usd_booked"),
        "fx_variance_reason", "fx_correction_usd", "created_at_utc", "captured_at_utc",
        F.coalesce("captured_at_utc", "created_at_utc").alias("recognised_at_utc"))


def only_reported(ledger: DataFrame, providers: DataFrame) -> DataFrame:
    """Only ledger rows of providers whose export is at hand."""
    return ledger.join(providers.select("psp").distinct(), "psp", "left_semi")


def reported_names(providers: DataFrame, most: int = 1000) -> list[str] | None:
    """Names of the providers in a stored provider table; None if there are more than ``most``."""
    names = [r["psp"] for r in providers.select("psp").distinct().limit(most + 1).collect()]
    return names if len(names) <= most else None


def hot_match_keys(ledger: DataFrame, providers: DataFrame, config: RunConfig = RunConfig(),
                   fraction: float = 0.001, least_hits: int = 100) -> list[tuple]:
    """The heaviest match keys of both sides, found on a sample of the key columns.

    The sample only steers the physical split in ``match_sides``; no result depends on it. A key with
    ``least_hits`` in the sample holds some ``least_hits / fraction`` rows. The list is bounded by
    ``most_hot_keys``; a key left off it is joined with the rest. The sides need no more than the key
    columns, so unfolded export lines will do (``staging.export_keys``).
    """
    def heavy(side: DataFrame) -> DataFrame:
        counted = (side.select(*MATCH_KEYS).dropna().sample(fraction, seed=7)
                   .groupBy(*MATCH_KEYS).agg(F.count("*").alias("hits")))
        return counted.filter(F.col("hits") >= least_hits)

    heavy_keys = heavy(ledger).unionByName(heavy(providers))
    found = (heavy_keys.groupBy(*MATCH_KEYS).agg(F.sum("hits").alias("hits"))
             .orderBy(F.desc("hits")).select(*MATCH_KEYS).limit(config.most_hot_keys).collect())
    return [tuple(row) for row in found]


def _ledger_side(ledger: DataFrame) -> DataFrame:
    return ledger.select(
        *MATCH_KEYS, "txn_id", "order_id", "sku", "country",
        *[F.col(old).alias(new) for old, new in _LEDGER_COLUMNS.items()],
        F.lit(True).alias("__in_engine"))


def _provider_side(providers: DataFrame) -> DataFrame:
    return providers.select(
        *MATCH_KEYS, *_PROVIDER_AS_IS,
        *[F.col(old).alias(new) for old, new in _PROVIDER_COLUMNS.items()],
        F.lit(True).alias("__in_psp"))


def match_sides(ledger: DataFrame, providers: DataFrame, hot: Sequence[tuple] = (),
                period_unit: str = "month") -> DataFrame:
    """Full outer match on provider, match key and operation, with raw differences and periods.

    Where a key repeats, the k-th row of one side (by time, then reference) meets the k-th of the other, so n and m
    rows give max(n, m), never n times m, and no money counts twice. Rows without a match key are spread over all
    tasks. Keys listed in ``hot`` (bounded, see ``hot_match_keys``) are numbered by range partitions and joined on
    the number as well, so such a key is many tasks.
    """
    ours, theirs = _ledger_side(ledger), _provider_side(providers)
    orders = (["engine_recognised_at_utc", "txn_id"], ["psp_recognised_at_utc", "psp_reference", "psp_amount_local"])
    if not hot:
        joined = paired_join(ours, theirs, MATCH_KEYS, *orders)
    else:
        listed = F.broadcast(ledger.sparkSession.createDataFrame(hot, ledger.select(*MATCH_KEYS).schema))
        cold = paired_join(ours.join(listed, MATCH_KEYS, "left_anti"),
                           theirs.join(listed, MATCH_KEYS, "left_anti"), MATCH_KEYS, *orders)
        split = paired_join(ours.join(listed, MATCH_KEYS, "left_semi"),
                            theirs.join(listed, MATCH_KEYS, "left_semi"), MATCH_KEYS, *orders, hot=True)
        joined = cold.unionByName(split)
    difference = {
        f"diff_{kind}": (money.or_zero(F.col(f"psp_amount_{kind}_settled"))
                         - money.or_zero(F.col(f"engine_amount_{kind}_settled")))
        for kind in ("local", "usd")}
    return (joined
            .withColumns({
                "order_ref": F.coalesce("order_id", "psp_order_ref"),
                "in_engine": F.coalesce("__in_engine", F.lit(False)),
                "in_psp": F.coalesce("__in_psp", F.lit(False)),
                "engine_period": time.period_of(F.col("engine_recognised_at_utc"), period_unit),
                "psp_period": time.period_of(F.col("psp_recognised_at_utc"), period_unit),
                **difference})
            .drop("order_id", "psp_order_ref", "__in_engine", "__in_psp"))

"""Run parameters, schemas and the fixed vocabularies every job shares."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 6)
PERCENT = T.DecimalType(9, 4)
TOTAL = T.DecimalType(38, 2)

# Timestamps are zone-less UTC (TIMESTAMP_NTZ), so no result depends on the session time zone.
UTC_TIME = T.TimestampNTZType()

# The vocabularies below must equal those of the published reports.
PROVIDERS = ("adyen", "dlocal", "google_play", "paypal_eu", "paypal_us")
CURRENCIES = ("USD", "EUR", "GBP", "BRL", "MXN", "ARS", "CLP", "COP")
OPERATIONS = ("sale", "refund", "chargeback")
LEDGER_STATUSES = ("settled", "declined", "pending")
PROVIDER_STATUSES = ("settled", "declined", "disputed")
SKUS = ("sub_monthly", "sub_quarterly", "sub_annual", "coach_addon")
FX_REASONS = ("none", "fx_not_applied", "fx_rate_mismatch", "fx_date_stale", "fx_rate_unpublished")
SCOPES = ("backend_fx", "gross", "fees")
RECON_STATUSES = ("matched", "explained", "unexplained")
BACKEND_FX_CAUSES = (
    "matched",
    "engine_fx_not_applied",
    "engine_fx_rate_mismatch",
    "engine_fx_date_stale",
    "engine_fx_rate_unpublished",
    "unexplained",
)
GROSS_CAUSES = (
    "matched",
    "psp_claims_sale",
    "psp_claims_refund",
    "psp_claims_chargeback",
    "engine_claims_sale",
    "engine_claims_refund",
    "engine_claims_chargeback",
    "psp_claims_declined",
    "psp_claims_disputed",
    "engine_capture_not_recorded",
    "psp_claims_partial_capture",
    "psp_claims_captured_different_period",
    "psp_claims_duplicate_row",
    "psp_fx_date_basis",
    "psp_claims_different_amount",
    "unexplained",
)
FEE_CAUSES = (
    "matched",
    "psp_fee_overcharge",
    "psp_fee_undercharge",
    "psp_fee_missing",
    "psp_claims_fee_out_of_contract",
    "fee_not_contracted",
    "unexplained",
)
BASE_LABELS = {
    "backend_fx": "backend booked gross",
    "gross": "provider gross",
    "fees": "provider fees charged",
}
WATERFALL_LINES = (
    "backend_booked",
    "backend_fx_faults",
    "backend_restated",
    "provider_variance",
    "provider_gross",
    "provider_fees",
    "net_receipts",
)

# The shape every provider export is brought to.
CONFORMED = T.StructType(
    [T.StructField(c, T.StringType()) for c in (
        "psp", "psp_account", "psp_reference", "order_ref", "match_key",
        "operation_type", "status", "currency")]
    + [T.StructField(c, MONEY) for c in (
        "amount_local", "amount_local_settled", "amount_local_authorised",
        "amount_local_duplicate", "fee_commission_local", "fee_markup_local",
        "fee_local", "fee_usd_native", "net_local")]
    + [T.StructField(c, UTC_TIME) for c in ("created_at_utc", "settled_at_utc")]
    + [T.StructField("batch_number", T.IntegerType())]
)


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one reconciliation run.

    ``reporting_month`` is None to report every period found in the data in one pass.
    """

    reporting_month: date | None = None
    export_window: tuple[date, date] | None = None
    period_unit: str = "month"
    output_dir: str | None = None
    google_play_account: str = "play_main"
    # A reference table may be broadcast up to this many rows (some 100 bytes a row); beyond it the
    # as-of join shuffles on (key, day).
    max_broadcast_rows: int = 1_000_000
    # Copies of the reference side a shuffled as-of join makes, so one currency is many tasks.
    asof_salts: int = 32
    # Rows a task of the Google Play fold sorts in memory, some 300 bytes each; a larger export is more tasks.
    fold_rows_per_task: int = 250_000
    # How many of the heaviest match keys may be joined apart from the rest.
    most_hot_keys: int = 2_000
    # Orders whose date is known to be written in the other order; None leaves that check out.
    expected_date_overrides: tuple[str, ...] | None = None
    # Whether a failed check stops the run before the report files are written; else it is only flagged.
    stop_on_failed_checks: bool = False

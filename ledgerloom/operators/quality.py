"""Checks that prove the totals close. Each returns the violating rows; an empty result passes.

Several recompute from the raw export, so as not to restate the operator they check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom import config as C
from ledgerloom.functions import money
from ledgerloom.operators.classify import is_true
from ledgerloom.operators.joins import keyed_join


def _off(amount: Column) -> Column:
    """More than half a cent away from zero."""
    return F.abs(amount) > F.lit(Decimal("0.005"))


# --- generic column checks ------------------------------------------------------------------------

def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All columns of a table in one aggregate pass: (column_name, n_rows) where nulls occur."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_rows")) for c in columns])
    return counts.select(F.explode(rows).alias("r")).select("r.*").filter("n_rows > 0")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls do not count."""
    return (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value"))
            .agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
            .select(F.lit(column).alias("column_name"), "value", "n_rows"))


def accepted_values(df: DataFrame, accepted: Mapping[str, Sequence[object]]) -> DataFrame:
    """Unlisted values of several columns in one pass; nulls are left to ``not_null``."""
    strays = [
        F.when(~F.col(c).isin(*values), F.struct(
            F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
        for c, values in accepted.items()]
    return (df.select(F.explode(F.array(*strays)).alias("r")).filter("r is not null")
            .groupBy("r.column_name", "r.value").agg(F.count("*").alias("n_rows")))


# table -> (columns that must be filled, columns that must be unique, column -> accepted values)
_PROVIDER_FILLED = ("order_ref", "psp_reference", "operation_type", "status", "amount_local",
                    "amount_local_settled")
COLUMN_CHECKS: dict[str, tuple[tuple[str, ...], tuple[str, ...], dict[str, tuple]]] = {
    "fx_rates": (
        ("rate_date", "currency", "usd_rate", "published_at", "rate_version", "is_current_rate"), (),
        {"currency": C.CURRENCIES[1:]}),
    "fee_schedule": (("psp", "psp_account", "valid_from", "percent_fee", "fixed_fee"), (), {}),
    "ledger": (
        ("txn_id", "order_id", "operation_type", "status", "psp", "sku", "country", "currency",
         "amount_local", "fx_rate_applied", "fx_date_applied", "amount_usd", "created_at_utc"),
        ("txn_id", "psp_reference"),
        {"operation_type": C.OPERATIONS, "status": C.LEDGER_STATUSES, "psp": C.PROVIDERS, "sku": C.SKUS,
         "currency": C.CURRENCIES}),
    "adyen": (_PROVIDER_FILLED, (), {"operation_type": C.OPERATIONS, "status": ("settled", "declined")}),
    "dlocal": (_PROVIDER_FILLED, (),
               {"operation_type": ("sale", "refund"), "status": C.PROVIDER_STATUSES}),
    "google_play": (
        ("match_key", "psp_account", "operation_type", "status", "amount_local", "created_at_utc"),
        ("match_key",), {"operation_type": ("sale", "refund"), "status": ("settled",)}),
    "paypal": (
        ("psp", "psp_account", *_PROVIDER_FILLED, "fee_local", "net_local", "created_at_utc",
         "date_format_overridden"),
        ("psp_reference",),
        {"psp": ("paypal_us", "paypal_eu"), "operation_type": C.OPERATIONS,
         "status": ("settled", "declined")}),
    "restated": (
        ("txn_id", "fx_variance_reason", "amount_usd_engine", "amount_usd_recon", "fx_correction_usd"),
        ("txn_id",), {"fx_variance_reason": C.FX_REASONS}),
    "providers": (("psp", "fx_rate_recon", "amount_usd_settled", "recognised_at_utc"), (), {}),
    "matched": (
        ("psp", "order_ref", "match_key", "operation_type", "in_engine", "in_psp", "diff_local", "diff_usd"),
        (), {"operation_type": C.OPERATIONS}),
    "classified": (
        ("gross_cause", "gross_status", "bug_diff_usd", "gross_diff_usd", "net_diff_usd"), (),
        {"bug_cause": C.BACKEND_FX_CAUSES, "gross_cause": C.GROSS_CAUSES, "net_cause": C.FEE_CAUSES,
         "gross_status": C.RECON_STATUSES, "bug_status": C.RECON_STATUSES}),
    "summary": (
        ("reporting_month", "psp", "recon_scope", "recon_status", "recon_cause", "n_rows", "abs_usd",
         "signed_usd", "base_label", "base_usd", "pct_of_base", "pct_of_scope_discrepancy",
         "pct_of_total_discrepancy"), (),
        {"recon_scope": C.SCOPES, "recon_status": C.RECON_STATUSES}),
    "waterfall": (
        ("reporting_month", "psp", "line_seq", "line_item", "usd", "is_subtotal"), (),
        {"line_seq": tuple(range(1, 8)), "line_item": C.WATERFALL_LINES}),
}


def column_checks(table: str, df: DataFrame, rules: Sequence[str] = ("not_null", "unique", "accepted_values")) -> DataFrame:
    """The generic checks of one table, or some of their rules: (table_name, rule, column_name, value, n_rows).

    One scan and one grouping for all columns: a row yields an entry for each rule it breaks, and one for each value
    that has to be unique, which is kept if it comes up again.
    """
    filled, distinct, accepted = COLUMN_CHECKS[table]

    def entry(rule: str, column: str, value: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), value.cast("string").alias("value"))

    entries = {
        "not_null": [F.when(F.col(c).isNull(), entry("not_null", c, F.lit(None))) for c in filled],
        "unique": [F.when(F.col(c).isNotNull(), entry("unique", c, F.col(c))) for c in distinct],
        "accepted_values": [F.when(~F.col(c).isin(*values), entry("accepted_values", c, F.col(c)))
                            for c, values in accepted.items()]}
    wanted = [one for rule in rules for one in entries[rule]]
    if not wanted:
        empty = "table_name string, rule string, column_name string, value string, n_rows bigint"
        return df.sparkSession.createDataFrame([], empty)
    return (df.select(F.explode(F.array_compact(F.array(*wanted))).alias("e"))
            .groupBy(F.lit(table).alias("table_name"), "e.rule", "e.column_name", "e.value").agg(F.count("*").alias("n_rows"))
            .filter("rule <> 'unique' or n_rows > 1"))


def observe_columns(table: str, df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a count of what breaks the rules that a row shows by itself, taken while it is written."""
    filled, _, accepted = COLUMN_CHECKS[table]
    seen = Observation()
    empty = reduce(Column.__or__, [F.col(c).isNull() for c in filled])
    stray = reduce(Column.__or__, [~F.col(c).isin(*values) for c, values in accepted.items()], F.lit(False))
    return df.observe(seen, F.count_if(empty).alias("not_null"), F.count_if(stray).alias("accepted_values")), seen


def observed_checks(table: str, df: DataFrame, seen: Observation) -> DataFrame:
    """The generic checks of a written table. Rules that no row broke on the way in are not looked at again."""
    broken = [rule for rule, count in seen.get.items() if count]
    return column_checks(table, df, [*broken, *(["unique"] if COLUMN_CHECKS[table][1] else [])])


# --- raw against staged ---------------------------------------------------------------------------

def authorised_not_double_counted(raw_adyen: DataFrame, adyen: DataFrame) -> DataFrame:
    """One staged sale per raw Settled row: the authorisation repeats the gross and is no sale."""
    raw = raw_adyen.filter(F.col("`Record Type`") == "Settled").select(
        F.lit(1).alias("raw"), F.lit(0).alias("staged"))
    staged = adyen.filter("operation_type = 'sale' and status = 'settled'").select(
        F.lit(0).alias("raw"), F.lit(1).alias("staged"))
    both = raw.unionByName(staged).agg(
        F.coalesce(F.sum("raw"), F.lit(0)).alias("raw_n"), F.coalesce(F.sum("staged"), F.lit(0)).alias("staged_n"))
    return both.filter("raw_n <> staged_n")


def repeated_lines_are_identical(raw_dlocal: DataFrame) -> DataFrame:
    """Copies may be collapsed only while rows of one key are the same in every field."""
    return (raw_dlocal.dropDuplicates().groupBy("transaction_id", "transaction_type")
            .agg(F.count("*").alias("n_distinct_rows")).filter("n_distinct_rows > 1"))


def minor_units_scaled(raw_dlocal: DataFrame, dlocal: DataFrame) -> DataFrame:
    """The provider's own USD at its own inverted rate is the witness: a wrong exponent is a factor
    of a hundred and cannot hide in a cent."""
    witness = raw_dlocal.dropDuplicates().select(
        F.col("transaction_id").alias("psp_reference"),
        F.when(F.col("transaction_type") == "REFUND", "refund").otherwise("sale").alias("operation_type"),
        F.col("usd_amount").cast(C.MONEY).alias("usd_amount_reported"),
        F.col("fx_rate").cast(C.RATE).alias("fx_rate_local_per_usd"))
    staged = dlocal.select("psp_reference", "operation_type", "currency", F.abs("amount_local").alias("amount_local"))
    implied = F.round(F.col("amount_local") / F.col("fx_rate_local_per_usd"), 2)
    return (keyed_join(staged, witness, ["psp_reference", "operation_type"], "inner")
            .filter(F.abs(F.col("usd_amount_reported") - implied) > F.lit(Decimal("0.01")))
            .select("psp_reference", "currency", "amount_local", "usd_amount_reported", "fx_rate_local_per_usd"))


def fee_rows_folded(raw_google: DataFrame) -> DataFrame:
    """As many fee entries as charges per second, product and country."""
    entry = F.col("`Transaction Type`")
    return (raw_google.groupBy(
                F.concat_ws(" ", "Transaction Date", "Transaction Time").alias("event_ts"),
                F.col("`Product ID`").alias("sku"), F.col("`Buyer Country`").alias("country"))
            .agg(F.count_if(entry == "Charge").alias("n_charge"), F.count_if(entry == "Google fee").alias("n_fee"))
            .filter("n_charge <> n_fee"))


def timezone_converted(google_play: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every staged row meets a capture in the ledger; unconverted times would miss them all."""
    captures = ledger.filter("psp = 'google_play'").select(
        F.col("captured_at_utc").alias("created_at_utc"), "sku", "country",
        F.lower("operation_type").alias("operation_type"))
    keys = ["created_at_utc", "sku", "country", "operation_type"]
    staged = google_play.select(
        "match_key", "created_at_utc", "operation_type",
        F.split_part("match_key", F.lit("|"), F.lit(2)).alias("sku"),
        F.split_part("match_key", F.lit("|"), F.lit(3)).alias("country"))
    return keyed_join(staged, captures, keys, "left_anti").select("match_key", "created_at_utc")


def date_override_bounded(paypal: DataFrame, pinned: DataFrame) -> DataFrame:
    """Date overrides are exactly the pinned orders: any other one, and a count that differs."""
    overridden = paypal.filter("date_format_overridden")
    strays = overridden.join(pinned.select("order_ref"), "order_ref", "left_anti").select(
        "psp", "order_ref", "psp_reference", "created_at_utc")
    tally = (overridden.select(F.lit(1).alias("seen"), F.lit(0).alias("pinned"))
             .unionByName(pinned.select(F.lit(0).alias("seen"), F.lit(1).alias("pinned")))
             .agg(F.coalesce(F.sum("seen"), F.lit(0)).alias("seen"), F.coalesce(F.sum("pinned"), F.lit(0)).alias("pinned"))
             .filter("seen <> pinned"))
    return strays.unionByName(tally.select(
        F.lit("expected_override_count").alias("psp"), F.col("seen").cast("string").alias("order_ref"),
        F.lit(None).cast("string").alias("psp_reference"),
        F.lit(None).cast(C.UTC_TIME).alias("created_at_utc")))


def dates_unresolved(paypal_typed: DataFrame) -> DataFrame:
    """Rows whose date lies outside the export window in either reading."""
    return paypal_typed.filter("date_unresolved").select("account", "order_ref", "psp_reference", "event_at")


def declared_zone_is_gmt(raw_paypal: DataFrame) -> DataFrame:
    zone = F.col("`Time Zone`")
    return raw_paypal.filter(zone != "GMT").groupBy(zone.alias("declared_time_zone")).agg(
        F.count("*").alias("n_rows"))


# The published PayPal tariff.
PAYPAL_RATE = {"USD": Decimal("0.0349")}
PAYPAL_OTHER_RATE = Decimal("0.029")
PAYPAL_FIXED = {"USD": Decimal("0.49"), "EUR": Decimal("0.35"), "GBP": Decimal("0.30")}


def paypal_fee_is_tariff(paypal: DataFrame) -> DataFrame:
    currency = F.col("currency")
    rate = F.lit(PAYPAL_OTHER_RATE)
    for code, value in PAYPAL_RATE.items():
        rate = F.when(currency == code, F.lit(value)).otherwise(rate)
    fixed = F.lit(None).cast(C.MONEY)
    for code, value in PAYPAL_FIXED.items():
        fixed = F.when(currency == code, F.lit(value)).otherwise(fixed)
    due = F.round(F.col("amount_local_settled") * rate, 2) + fixed
    return (paypal.filter((F.col("operation_type") == "sale") & (F.col("status") == "settled"))
            .filter(F.col("fee_local") != due)
            .select("psp", "order_ref", "currency", "amount_local_settled", "fee_local"))


def reversals_resolve(paypal: DataFrame) -> DataFrame:
    """A reversal points at an earlier settled sale of the same account and order, not smaller."""
    sale = paypal.select(
        "psp", F.col("psp_reference").alias("related_psp_reference"), F.lit(True).alias("found"),
        *[F.col(c).alias(f"sale_{c}") for c in (
            "operation_type", "status", "order_ref", "amount_local", "created_at_utc")])
    reversals = paypal.filter(F.col("operation_type").isin("refund", "chargeback"))
    linked = keyed_join(reversals, sale, ["psp", "related_psp_reference"], "left")
    broken = (F.col("related_psp_reference").isNull() | F.col("found").isNull()
              | is_true(F.col("sale_operation_type") != "sale")
              | is_true(F.col("sale_status") != "settled")
              | is_true(F.col("sale_order_ref") != F.col("order_ref"))
              | is_true(F.abs("amount_local") > F.col("sale_amount_local"))
              | is_true(F.col("created_at_utc") < F.col("sale_created_at_utc")))
    return linked.filter(broken).select("psp", "order_ref", "psp_reference", "related_psp_reference")


# --- the ledger and the rates ---------------------------------------------------------------------

def capture_completeness(ledger: DataFrame) -> DataFrame:
    status, captured = F.col("status"), F.col("captured_at_utc")
    wrong = (((status == "settled") & captured.isNull())
             | (status.isin("declined", "pending") & captured.isNotNull())
             | is_true(captured < F.col("created_at_utc")))
    return ledger.filter(wrong).select("txn_id", "status", "captured_at_utc")


def reference_coverage(ledger: DataFrame) -> DataFrame:
    """A provider reference exists exactly where the provider issues one."""
    issues = F.col("psp") != "google_play"
    return ledger.filter(issues != F.col("psp_reference").isNotNull()).select("txn_id", "psp", "psp_reference")


def booked_usd_reproducible(ledger: DataFrame) -> DataFrame:
    again = money.convert(F.col("amount_local"), F.col("fx_rate_applied"))
    return ledger.withColumn("amount_usd_recomputed", again).filter(
        "amount_usd <> amount_usd_recomputed").select(
        "txn_id", "amount_local", "fx_rate_applied", "amount_usd", "amount_usd_recomputed")


def fx_correction_arithmetic(restated: DataFrame) -> DataFrame:
    due = money.convert(F.col("amount_local"), F.col("fx_rate_expected"))
    return restated.filter(F.col("amount_usd_recon") != due).select(
        "txn_id", "fx_variance_reason", "amount_local", "fx_rate_expected", "amount_usd_engine",
        "amount_usd_recon")


def grain_preserved(before: DataFrame, after: DataFrame) -> DataFrame:
    """A lookup must not change the number of rows."""
    tally = (before.select(F.lit(1).alias("b"), F.lit(0).alias("a"))
             .unionByName(after.select(F.lit(0).alias("b"), F.lit(1).alias("a")))
             .agg(F.coalesce(F.sum("b"), F.lit(0)).alias("n_before"),
                  F.coalesce(F.sum("a"), F.lit(0)).alias("n_after")))
    return tally.filter("n_before <> n_after")


def rate_grain(versions: DataFrame) -> DataFrame:
    return (versions.groupBy("rate_date", "currency", "rate_version").agg(F.count("*").alias("n_rows"))
            .filter("n_rows > 1"))


# --- the reconciliation ---------------------------------------------------------------------------

def fixed_fee_currency_handled(classified: DataFrame) -> DataFrame:
    return classified.filter(
        "fixed_fee <> 0 and fixed_fee_currency is not null and fixed_fee_currency <> psp_currency"
    ).select("psp", "order_ref", "psp_currency", "fixed_fee", "fixed_fee_currency")


def net_ties_to_gross_less_fees(providers: DataFrame) -> DataFrame:
    return providers.filter("net_local is not null and net_local <> amount_local_settled - fee_local").select(
        "psp", "order_ref", "operation_type", "amount_local_settled", "fee_local", "net_local")


def recon_grain(matched: DataFrame) -> DataFrame:
    return (matched.groupBy("psp", "match_key", "operation_type").agg(F.count("*").alias("n_rows"))
            .filter("n_rows > 1"))


def matched_rows_agree(classified: DataFrame) -> DataFrame:
    """Nothing hides among the matched rows: status, currency and amounts are equal."""
    differs = (~(F.col("in_engine") & F.col("in_psp"))
               | is_true(F.col("engine_status") != F.col("psp_status"))
               | is_true(F.col("engine_currency") != F.col("psp_currency"))
               | (F.col("diff_local") != 0) | (F.col("diff_usd") != 0))
    return classified.filter((F.col("gross_cause") == "matched") & differs)


def matched_fees_agree(classified: DataFrame) -> DataFrame:
    return classified.filter("net_cause = 'matched' and net_diff_usd <> 0")


def fee_verdict_on_settled_sales(classified: DataFrame) -> DataFrame:
    settled_sale = is_true(
        F.col("in_psp") & (F.col("operation_type") == "sale") & (F.col("psp_status") == "settled"))
    return classified.filter(settled_sale != F.col("net_cause").isNotNull()).select(
        "psp", "order_ref", "operation_type", "psp_status", "net_cause")


def _period_keys(df: DataFrame) -> list[str]:
    return [c for c in ("reporting_month", "psp") if c in df.columns]


def buckets_reconcile(classified: DataFrame) -> DataFrame:
    """Per provider and scope, the three buckets add up to a control recomputed from the amounts."""
    charged, agreed = money.or_zero(F.col("psp_fee_usd")), money.or_zero(F.col("fee_usd_contracted"))
    scopes = {
        "backend_fx": (F.col("engine_in_period") & F.col("bug_cause").isNotNull(), "bug",
                       F.col("engine_amount_usd_period") - F.col("engine_amount_usd_booked_period")),
        "gross": (F.col("in_period"), "gross",
                  F.col("psp_amount_usd_period") + F.col("psp_amount_usd_duplicate_period")
                  - F.col("engine_amount_usd_period")),
        "fees": (F.col("psp_in_period") & F.col("net_cause").isNotNull(), "net", agreed - charged)}
    entries = F.array(*[
        F.when(present, F.struct(
            F.lit(scope).alias("recon_scope"), F.col(f"{prefix}_status").alias("bucket"),
            F.col(f"{prefix}_diff_usd").cast(C.MONEY).alias("diff"), control.cast(C.MONEY).alias("control")))
        for scope, (present, prefix, control) in scopes.items()])
    keys = _period_keys(classified)
    long = (classified.select(*keys, F.explode(entries).alias("e"))
            .filter("e is not null").select(*keys, "e.*"))
    totals = {
        f"{bucket}_usd": F.sum(F.when(F.col("bucket") == bucket, F.col("diff")).otherwise(money.zero()))
        for bucket in C.RECON_STATUSES}
    table = long.groupBy(*keys, "recon_scope").agg(
        *[total.alias(name) for name, total in totals.items()], F.sum("control").alias("control_usd"))
    return table.filter(_off(F.col("matched_usd") + F.col("explained_usd") + F.col("unexplained_usd")
                             - F.col("control_usd")))


def waterfall_closes(classified: DataFrame) -> DataFrame:
    totals = classified.filter("in_period").groupBy(*_period_keys(classified)).agg(
        F.sum("engine_amount_usd_booked_period").alias("booked_usd"),
        F.sum("bug_diff_usd").alias("bugs_usd"),
        F.sum("gross_diff_usd").alias("gross_usd"),
        (F.sum("psp_amount_usd_period") + F.sum("psp_amount_usd_duplicate_period")).alias("psp_usd"))
    return totals.filter(_off(F.col("booked_usd") + F.col("bugs_usd") + F.col("gross_usd") - F.col("psp_usd")))


def residual_is_stated(summary: DataFrame) -> DataFrame:
    return (summary.groupBy("reporting_month", "psp", "recon_scope")
            .agg(F.count_if(F.col("recon_status") == "unexplained").alias("unexplained_rows"))
            .filter("unexplained_rows <> 1"))


def base_covers_scope(summary: DataFrame) -> DataFrame:
    return (summary.groupBy("reporting_month", "psp", "recon_scope")
            .agg(F.max("base_usd").alias("base_usd"), F.sum("abs_usd").alias("scope_abs_usd"))
            .filter(F.col("scope_abs_usd") > F.col("base_usd") + F.lit(Decimal("0.005"))))


def _line(item: str) -> Column:
    return F.max(F.when(F.col("line_item") == item, F.col("usd")))


def subtotals_close(waterfall: DataFrame) -> DataFrame:
    wide = waterfall.groupBy("reporting_month", "psp").agg(
        *[_line(item).alias(item) for item in C.WATERFALL_LINES])
    gaps = [("backend_booked", "backend_fx_faults", "backend_restated"),
            ("backend_restated", "provider_variance", "provider_gross"),
            ("provider_gross", "provider_fees", "net_receipts")]
    wrong = F.lit(False)
    for start, step, end in gaps:
        wrong = wrong | _off(F.col(start) + F.col(step) - F.col(end))
    return wide.filter(wrong)


def waterfall_ties_to_source(waterfall: DataFrame, classified: DataFrame) -> DataFrame:
    """The three anchor levels straight from the classified rows, two steps behind the waterfall."""
    keys = ["reporting_month", "psp"]
    shown = waterfall.groupBy(*keys).agg(
        _line("backend_booked").alias("booked_usd"), _line("provider_gross").alias("gross_usd"),
        _line("net_receipts").alias("net_usd"))
    gross = F.sum(F.col("psp_amount_usd_period") + F.col("psp_amount_usd_duplicate_period"))
    fees = F.sum(F.when(F.col("psp_in_period"), money.or_zero(F.col("psp_fee_usd"))).otherwise(money.zero()))
    control = classified.filter("in_period").groupBy(*keys).agg(
        F.sum("engine_amount_usd_booked_period").alias("control_booked_usd"),
        gross.alias("control_gross_usd"), (gross - fees).alias("control_net_usd"))
    # The undated period is null and equal to itself.
    tied = shown.join(control, shown["reporting_month"].eqNullSafe(control["reporting_month"]) & (shown["psp"] == control["psp"]))
    tied = tied.drop(control["reporting_month"], control["psp"])
    return tied.filter(_off(F.col("booked_usd") - F.col("control_booked_usd"))
                       | _off(F.col("gross_usd") - F.col("control_gross_usd"))
                       | _off(F.col("net_usd") - F.col("control_net_usd")))

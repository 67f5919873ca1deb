"""The same results in plain SQL for the checking engine, written apart from the Spark operators:
as-of joins, windows and self-joins there, calendars, groupings and folds here."""

from __future__ import annotations

import re

from ledgerloom.plans import exports
from ledgerloom.plans.derived import EXPORT_DAYS
from ledgerloom.plans.dialect import CHECK


def _steps(steps: exports.Steps) -> str:
    *earlier, (_, last) = steps
    head = ", ".join(f"{name} AS ({text})" for name, text in earlier)
    return (f"WITH {head} {last}" if head else last).replace("`", '"')


def asof(source: str, prefix: str, day: str) -> str:
    """Rows of ``source`` with the rate in force on ``day``."""
    return (f"SELECT s.*, r.usd_rate AS {prefix}_rate, r.rate_date AS {prefix}_rate_date FROM "
            f"(SELECT *, {day} AS asof_day FROM {source}) s ASOF LEFT JOIN current_rates r "
            f"ON r.currency = s.currency AND s.asof_day >= r.rate_date")


def drop_asof(sql: str) -> str:
    return f"SELECT * EXCLUDE (asof_day) FROM ({sql})"


def to_utc(ts: str, zone: str) -> str:
    return f"timezone('UTC', timezone('{zone}', CAST({ts} AS TIMESTAMP)))"


def usd(amount: str, rate: str) -> str:
    return f"CAST(round(CAST({amount} AS DECIMAL(28,2)) * {rate}, 2) AS DECIMAL(18,2))"


def percent(amount: str, pct: str) -> str:
    return f"CAST(round(CAST({amount} AS DECIMAL(24,2)) * {pct} * 0.01, 2) AS DECIMAL(18,2))"


def cents(amount: str) -> str:
    return f"CAST({amount} * 100 AS HUGEINT)"


def share(part: str, whole: str, digits: int) -> str:
    scale = 10**digits
    return (f"coalesce(CAST((2 * {100 * scale} * {cents(part)} + abs({cents(whole)})) "
            f"// nullif(2 * abs({cents(whole)}), 0) * sign({whole}) AS DOUBLE) / {scale}, 0)")


def first_of(*arms: tuple[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN {value}" for value, cond in arms) + " END"


NONE = "CAST(NULL AS DECIMAL(18,2))"

_payments_rated = (
    "WITH base AS (" + _steps(exports.payments(CHECK)) + "), "
    "a AS (" + drop_asof(asof("base", "created", "CAST(created_at AS DATE)")) + "), "
    "b AS (" + drop_asof(asof("a", "captured", "CAST(captured_at AS DATE)")) + "), "
    "c AS (" + drop_asof(asof("b", "reversed", "CAST(reversed_at AS DATE)")) + "), "
    "e AS (" + drop_asof(asof("c", "previous", "created_rate_date - 1")) + ") "
    "SELECT *, previous_rate_date AS previous_date FROM e")

_contracts = ", ".join(
    f"('{p}', '{a}', DATE '{v}', CAST({pct} AS DECIMAL(9,4)), CAST({fee} AS DECIMAL(18,2)), nullif('{cur}', ''))"
    for p, a, v, pct, fee, cur in exports.CONTRACT_ROWS)


def _paypal() -> str:
    def read(order: str) -> str:
        return f"""try_strptime("Date" || ' ' || "Time", '{order} %H:%M:%S')"""

    def amount(column: str) -> str:
        return f"""CAST(replace("{column}", ',', '.') AS DECIMAL(18,2))"""

    window = f"CAST(export_month AS DATE) AND CAST(export_month AS DATE) + {EXPORT_DAYS}"
    return f"""
WITH parsed AS (SELECT *, {read('%m/%d/%Y')} AS mdy, {read('%d/%m/%Y')} AS dmy FROM paypal_raw),
ordered AS (SELECT *, if(account = 'paypal_us', mdy, dmy) AS first_reading,
                      if(account = 'paypal_us', dmy, mdy) AS other_reading FROM parsed),
copies AS (SELECT *, count(*) OVER (PARTITION BY account, "Transaction ID") AS n FROM ordered),
one AS (SELECT DISTINCT * FROM copies),
typed AS (
  SELECT account, "Transaction ID" AS psp_reference, nullif("Reference Txn ID", '') AS related_psp_reference,
    "Invoice ID" AS order_ref, "Currency" AS currency, {amount('Gross')} AS gross, {amount('Fee')} AS fee,
    {amount('Net')} AS net, n,
    map {{'Website Payment': 'sale', 'Refund': 'refund', 'Payment Reversal': 'chargeback'}}["Type"] AS operation_type,
    if("Status" = 'Denied', 'declined', 'settled') AS status,
    coalesce(CAST(first_reading AS DATE) BETWEEN {window}, false) AS in_window, first_reading, other_reading,
    coalesce(CAST(other_reading AS DATE) BETWEEN {window}, false) AS other_in_window
  FROM one)
SELECT account AS psp, account AS psp_account, psp_reference, related_psp_reference, order_ref,
  order_ref AS match_key, operation_type, status, currency, gross AS amount_local,
  if(status = 'settled', gross, 0) AS amount_local_settled, {NONE} AS amount_local_authorised,
  CASE WHEN n > 1 THEN CAST(if(status = 'settled', gross, 0) * (n - 1) AS DECIMAL(18,2)) END AS amount_local_duplicate,
  {NONE} AS fee_commission_local, {NONE} AS fee_markup_local, -fee AS fee_local, {NONE} AS fee_usd_native,
  net AS net_local, if(in_window, first_reading, other_reading) AS created_at_utc,
  CASE WHEN status = 'settled' THEN if(in_window, first_reading, other_reading) END AS settled_at_utc,
  CAST(NULL AS INTEGER) AS batch_number, NOT in_window AS date_format_overridden,
  NOT in_window AND NOT other_in_window AS date_unresolved
FROM typed"""


def _adyen() -> str:
    return f"""
WITH typed AS (
  SELECT "Merchant Account" AS psp_account, "Psp Reference" AS psp_reference, "Merchant Reference" AS order_ref,
    "Record Type" AS entry, {to_utc('"Creation Date"', 'Europe/Amsterdam')} AS event_at, "Gross Currency" AS currency,
    CAST("Gross Credit" AS DECIMAL(18,2)) AS credit, CAST("Gross Debit" AS DECIMAL(18,2)) AS debit,
    CAST("Commission" AS DECIMAL(18,2)) AS commission, CAST("Markup" AS DECIMAL(18,2)) AS markup,
    CAST("Net Credit" AS DECIMAL(18,2)) AS net_credit, CAST("Net Debit" AS DECIMAL(18,2)) AS net_debit,
    CAST("Batch Number" AS INTEGER) AS batch_number
  FROM adyen_raw),
paired AS (
  SELECT t.*, a.credit AS asked, a.event_at AS asked_at
  FROM typed t LEFT JOIN typed a ON a.order_ref = t.order_ref AND a.entry = 'Authorised' AND t.entry = 'Settled'
  WHERE t.entry <> 'Authorised')
SELECT 'adyen' AS psp, psp_account, psp_reference, order_ref, order_ref AS match_key,
  CASE entry WHEN 'Refunded' THEN 'refund' WHEN 'Chargeback' THEN 'chargeback' ELSE 'sale' END AS operation_type,
  if(entry = 'Refused', 'declined', 'settled') AS status, currency,
  if(credit IS NOT NULL, credit, -debit) AS amount_local,
  CASE entry WHEN 'Settled' THEN credit WHEN 'Refused' THEN 0 ELSE -debit END AS amount_local_settled,
  asked AS amount_local_authorised, {NONE} AS amount_local_duplicate,
  commission AS fee_commission_local, markup AS fee_markup_local,
  CAST(coalesce(commission, 0) + coalesce(markup, 0) AS DECIMAL(18,2)) AS fee_local, {NONE} AS fee_usd_native,
  coalesce(net_credit, -net_debit) AS net_local, if(entry = 'Settled', asked_at, event_at) AS created_at_utc,
  CASE WHEN entry <> 'Refused' THEN event_at END AS settled_at_utc, batch_number
FROM paired"""


def _dlocal(raw: str = "dlocal_raw") -> str:
    return f"""
WITH copies AS (SELECT *, count(*) OVER (PARTITION BY transaction_id, transaction_type) AS n FROM {raw}),
one AS (
  SELECT DISTINCT *, if(transaction_type = 'REFUND', -1, 1) * CAST(CAST(local_amount AS DECIMAL(24,4))
      * if(currency_exponent = '0', 1.00, 0.01) AS DECIMAL(18,2)) AS signed,
    map {{'PAID': 'settled', 'REFUNDED': 'settled', 'REJECTED': 'declined', 'IN_MEDIATION': 'disputed'}}[status] AS state
  FROM copies)
SELECT 'dlocal' AS psp, CAST(NULL AS VARCHAR) AS psp_account, transaction_id AS psp_reference,
  invoice_id AS order_ref, invoice_id AS match_key, if(transaction_type = 'REFUND', 'refund', 'sale') AS operation_type,
  state AS status, currency, CAST(signed AS DECIMAL(18,2)) AS amount_local,
  CAST(if(state = 'settled', signed, 0) AS DECIMAL(18,2)) AS amount_local_settled, {NONE} AS amount_local_authorised,
  CASE WHEN n > 1 THEN CAST(if(state = 'settled', signed, 0) * (n - 1) AS DECIMAL(18,2)) END AS amount_local_duplicate,
  {NONE} AS fee_commission_local, {NONE} AS fee_markup_local, {NONE} AS fee_local,
  CAST(fee_usd AS DECIMAL(18,2)) AS fee_usd_native, {NONE} AS net_local,
  CAST(created_at_utc AS TIMESTAMP) AS created_at_utc,
  CASE WHEN state = 'settled' THEN CAST(created_at_utc AS TIMESTAMP) END AS settled_at_utc,
  CAST(NULL AS INTEGER) AS batch_number
FROM one"""


def _google() -> str:
    local = """strptime("Transaction Date" || ' ' || "Transaction Time", '%b %-d, %Y %H:%M:%S')"""
    return f"""
WITH typed AS (
  SELECT {to_utc(local, 'America/Los_Angeles')} AS event_at, "Transaction Type" AS entry, "Product ID" AS sku,
    "Buyer Country" AS country, "Buyer Currency" AS currency,
    CAST("Amount (Buyer Currency)" AS DECIMAL(18,2)) AS amount,
    CAST("Amount (Merchant Currency)" AS DECIMAL(18,2)) AS amount_usd FROM google_play_raw),
fees AS (
  SELECT event_at, sku, country, CAST(-sum(amount) AS DECIMAL(18,2)) AS fee, CAST(-sum(amount_usd) AS DECIMAL(18,2)) AS fee_usd
  FROM typed WHERE entry = 'Google fee' GROUP BY ALL)
SELECT 'google_play' AS psp, '{exports.GOOGLE_ACCOUNT}' AS psp_account, CAST(NULL AS VARCHAR) AS psp_reference,
  CAST(NULL AS VARCHAR) AS order_ref, strftime(t.event_at, '%Y-%m-%dT%H:%M:%S') || '|' || t.sku || '|' || t.country AS match_key,
  if(entry = 'Charge', 'sale', 'refund') AS operation_type, 'settled' AS status, currency, amount AS amount_local,
  amount AS amount_local_settled, {NONE} AS amount_local_authorised, {NONE} AS amount_local_duplicate,
  {NONE} AS fee_commission_local, {NONE} AS fee_markup_local, CASE WHEN entry = 'Charge' THEN fee END AS fee_local,
  CASE WHEN entry = 'Charge' THEN fee_usd END AS fee_usd_native, {NONE} AS net_local,
  t.event_at AS created_at_utc, t.event_at AS settled_at_utc, CAST(NULL AS INTEGER) AS batch_number
FROM typed t LEFT JOIN fees f ON f.event_at = t.event_at AND f.sku = t.sku AND f.country = t.country
WHERE entry <> 'Google fee'"""


_moved_ledger = "if(status = 'settled', if(operation_type = 'sale', {0}, -{0}), 0)"

CTES: dict[str, str] = {
    "fx_rates_raw": _steps(exports.fx_rates(CHECK)),
    "rate_versions": """
SELECT CAST(rate_date AS DATE) AS rate_date, currency, CAST(usd_rate AS DECIMAL(18,6)) AS usd_rate,
  CAST(published_at AS TIMESTAMP) AS published_at,
  row_number() OVER (PARTITION BY rate_date, currency ORDER BY published_at, usd_rate) AS rate_version,
  NOT EXISTS (SELECT 1 FROM fx_rates_raw later WHERE later.rate_date = f.rate_date
              AND later.currency = f.currency AND later.published_at > f.published_at) AS is_current_rate
FROM fx_rates_raw f""",
    "current_rates": "SELECT rate_date, currency, usd_rate FROM rate_versions WHERE is_current_rate",
    "payments": _payments_rated,
    "provider_view": _steps(exports.provider_view(CHECK)),
    "adyen_raw": _steps(exports.adyen(CHECK)),
    "dlocal_raw": _steps(exports.dlocal(CHECK)),
    "google_play_raw": _steps(exports.google_play(CHECK)),
    "paypal_raw": _steps(exports.paypal(CHECK)),
    "payment_log_raw": _steps(exports.payment_log(CHECK)),
    "contracts": ("SELECT *, lead(valid_from) OVER (PARTITION BY psp, psp_account ORDER BY valid_from) AS until "
                  f"FROM (VALUES {_contracts}) c(psp, psp_account, valid_from, percent_fee, fixed_fee, fixed_fee_currency)"),
    "ledger": """
SELECT txn_id, order_id, lower(operation_type) AS operation_type, lower(status) AS status, psp, psp_reference, sku,
  country, currency, CAST(amount_local AS DECIMAL(18,2)) AS amount_local,
  CAST(fx_rate_applied AS DECIMAL(18,6)) AS fx_rate_applied, CAST(fx_date_applied AS DATE) AS fx_date_applied,
  CAST(amount_usd AS DECIMAL(18,2)) AS amount_usd, CAST(created_at_utc AS TIMESTAMP) AS created_at_utc,
  CAST(captured_at_utc AS TIMESTAMP) AS captured_at_utc FROM payment_log_raw""",
    "adyen": _adyen(),
    "dlocal": _dlocal(),
    "google_play": _google(),
    "paypal": _paypal(),
    "conformed": ("SELECT * FROM adyen UNION ALL BY NAME SELECT * FROM dlocal UNION ALL BY NAME SELECT * FROM google_play "
                  "UNION ALL BY NAME SELECT * EXCLUDE (related_psp_reference, date_format_overridden, date_unresolved) FROM paypal"),
    "restated": f"""
WITH found AS ({asof('ledger', 'right', 'CAST(created_at_utc AS DATE)')}),
known AS (
  SELECT f.* EXCLUDE (asof_day, right_rate, right_rate_date), right_rate_date AS fx_date_expected,
    if(f.currency = 'USD', 1, right_rate) AS fx_rate_expected, if(f.currency = 'USD', 1, p.usd_rate) AS fx_rate_published
  FROM found f LEFT JOIN current_rates p ON p.currency = f.currency AND p.rate_date = f.fx_date_applied),
named AS (
  SELECT *, {first_of(("'none'", "currency = 'USD'"), ("'fx_rate_unpublished'", "fx_rate_published IS NULL"),
                      ("'fx_not_applied'", "fx_rate_applied = 1"),
                      ("'fx_rate_mismatch'", "fx_rate_applied <> fx_rate_published"),
                      ("'fx_date_stale'", "fx_date_applied <> fx_date_expected"), ("'none'", "true"))} AS fx_variance_reason,
    coalesce({usd('amount_local', 'fx_rate_expected')}, amount_usd) AS amount_usd_recon
  FROM known)
SELECT * RENAME (amount_usd AS amount_usd_engine), amount_usd - amount_usd_recon AS fx_correction_usd FROM named""",
    "priced": f"""
SELECT * EXCLUDE (found_rate, found_rate_date, asof_day), if(currency = 'USD', 1, found_rate) AS fx_rate_recon,
  {usd('amount_local', "if(currency = 'USD', 1, found_rate)")} AS amount_usd,
  {usd('amount_local_settled', "if(currency = 'USD', 1, found_rate)")} AS amount_usd_settled,
  {usd('amount_local_duplicate', "if(currency = 'USD', 1, found_rate)")} AS amount_usd_duplicate,
  coalesce(fee_usd_native, {usd('fee_local', "if(currency = 'USD', 1, found_rate)")}) AS fee_usd,
  coalesce(settled_at_utc, created_at_utc) AS recognised_at_utc
FROM ({asof('conformed', 'found', 'CAST(created_at_utc AS DATE)')})""",
    "providers": f"""
WITH terms AS (
  SELECT p.*, c.percent_fee, c.fixed_fee, c.fixed_fee_currency,
    p.operation_type = 'sale' AND p.status = 'settled' AND c.percent_fee IS NOT NULL AS due
  FROM priced p LEFT JOIN contracts c ON c.psp = p.psp AND c.psp_account = p.psp_account
    AND CAST(p.recognised_at_utc AS DATE) >= c.valid_from
    AND (c.until IS NULL OR CAST(p.recognised_at_utc AS DATE) < c.until)),
agreed AS (
  SELECT *, CASE WHEN due THEN CAST({percent('amount_local_settled', 'percent_fee')}
      + if(coalesce(fixed_fee_currency, currency) = currency, fixed_fee, 0) AS DECIMAL(18,2)) END AS fee_local_contracted
  FROM terms)
SELECT * EXCLUDE (due), CASE WHEN NOT coalesce(due, false) THEN NULL
  WHEN fee_usd_native IS NOT NULL THEN CAST({percent('amount_usd_settled', 'percent_fee')}
      + if(coalesce(fixed_fee_currency, '') = 'USD', fixed_fee, 0) AS DECIMAL(18,2))
  ELSE {usd('fee_local_contracted', 'fx_rate_recon')} END AS fee_usd_contracted
FROM agreed""",
    "signed": f"""
SELECT txn_id, order_id, CASE WHEN psp <> 'google_play' THEN order_id
    ELSE strftime(captured_at_utc, '%Y-%m-%dT%H:%M:%S') || '|' || sku || '|' || country END AS match_key,
  psp, psp_reference, operation_type, status, sku, country, currency,
  if(operation_type = 'sale', amount_local, -amount_local) AS amount_local,
  CAST({_moved_ledger.format('amount_local')} AS DECIMAL(18,2)) AS amount_local_settled,
  CAST({_moved_ledger.format('amount_usd_recon')} AS DECIMAL(18,2)) AS amount_usd_settled,
  CAST({_moved_ledger.format('amount_usd_engine')} AS DECIMAL(18,2)) AS amount_usd_booked,
  fx_variance_reason, fx_correction_usd, created_at_utc, captured_at_utc,
  coalesce(captured_at_utc, created_at_utc) AS recognised_at_utc FROM restated""",
    "matched": """
SELECT coalesce(e.psp, p.psp) AS psp, coalesce(e.match_key, p.match_key) AS match_key,
  coalesce(e.operation_type, p.operation_type) AS operation_type, coalesce(e.order_id, p.order_ref) AS order_ref,
  e.txn_id, e.sku, e.country, e.status AS engine_status, e.currency AS engine_currency,
  e.amount_local AS engine_amount_local, e.amount_local_settled AS engine_amount_local_settled,
  e.amount_usd_settled AS engine_amount_usd_settled, e.amount_usd_booked AS engine_amount_usd_booked,
  e.fx_variance_reason AS engine_fx_variance_reason, e.recognised_at_utc AS engine_recognised_at_utc,
  p.psp_account, p.psp_reference, p.status AS psp_status, p.currency AS psp_currency, p.amount_local AS psp_amount_local,
  p.amount_local_settled AS psp_amount_local_settled, p.amount_local_authorised AS psp_amount_local_authorised,
  p.amount_usd_settled AS psp_amount_usd_settled, p.amount_usd_duplicate AS psp_amount_usd_duplicate,
  p.fee_local AS psp_fee_local, p.fee_usd AS psp_fee_usd, p.fee_local_contracted, p.fee_usd_contracted,
  p.fixed_fee, p.fixed_fee_currency, p.recognised_at_utc AS psp_recognised_at_utc,
  e.txn_id IS NOT NULL AS in_engine, p.psp IS NOT NULL AS in_psp,
  coalesce(p.amount_local_settled, 0) - coalesce(e.amount_local_settled, 0) AS diff_local,
  coalesce(p.amount_usd_settled, 0) - coalesce(e.amount_usd_settled, 0) AS diff_usd,
  CAST(date_trunc('year', e.recognised_at_utc) AS DATE) AS engine_period,
  CAST(date_trunc('year', p.recognised_at_utc) AS DATE) AS psp_period
FROM signed e FULL JOIN providers p ON p.psp = e.psp AND p.match_key = e.match_key AND p.operation_type = e.operation_type""",
    "scoped": """
WITH periods AS (
  SELECT *, engine_period AS reporting_month FROM matched WHERE in_engine
  UNION ALL SELECT *, psp_period FROM matched WHERE in_psp AND NOT (in_engine AND psp_period IS NOT DISTINCT FROM engine_period)),
flagged AS (
  SELECT *, in_engine AND engine_period IS NOT DISTINCT FROM reporting_month AS engine_in_period,
    in_psp AND psp_period IS NOT DISTINCT FROM reporting_month AS psp_in_period FROM periods)
SELECT *, engine_in_period OR psp_in_period AS in_period,
  if(engine_in_period, coalesce(engine_amount_usd_settled, 0), 0) AS engine_amount_usd_period,
  if(engine_in_period, coalesce(engine_amount_usd_booked, 0), 0) AS engine_amount_usd_booked_period,
  if(psp_in_period, coalesce(psp_amount_usd_settled, 0), 0) AS psp_amount_usd_period,
  if(psp_in_period, coalesce(psp_amount_usd_duplicate, 0), 0) AS psp_amount_usd_duplicate_period FROM flagged""",
    "diffs": """
SELECT *, psp_amount_usd_period + psp_amount_usd_duplicate_period - engine_amount_usd_period AS gross_diff_usd,
  engine_amount_usd_period - engine_amount_usd_booked_period AS bug_diff_usd,
  CASE WHEN NOT psp_in_period THEN 0 WHEN fee_usd_contracted IS NOT NULL THEN fee_usd_contracted - coalesce(psp_fee_usd, 0)
    WHEN operation_type = 'sale' AND psp_status = 'settled' THEN -coalesce(psp_fee_usd, 0) ELSE 0 END AS net_diff_usd,
  coalesce(operation_type = 'sale' AND psp_status = 'settled', false) AS settled_sale FROM scoped""",
    "caused": "SELECT *, " + first_of(
        ("'matched'", "in_engine AND engine_fx_variance_reason = 'none'"),
        ("'engine_' || engine_fx_variance_reason", "in_engine")) + " AS bug_cause, " + first_of(
        ("'psp_fee_missing'", "fee_local_contracted IS NOT NULL AND psp_fee_local IS NULL AND psp_fee_usd IS NULL"),
        ("'psp_fee_overcharge'", "fee_local_contracted IS NOT NULL AND if(psp_fee_local IS NULL, psp_fee_usd > fee_usd_contracted, psp_fee_local > fee_local_contracted)"),
        ("'psp_fee_undercharge'", "fee_local_contracted IS NOT NULL AND if(psp_fee_local IS NULL, psp_fee_usd < fee_usd_contracted, psp_fee_local < fee_local_contracted)"),
        ("'matched'", "fee_local_contracted IS NOT NULL"),
        ("'psp_claims_fee_out_of_contract'", "settled_sale AND coalesce(psp_fee_usd, 0) <> 0"),
        ("'fee_not_contracted'", "settled_sale")) + " AS net_cause, " + first_of(
        ("'psp_claims_' || operation_type", "NOT in_engine"),
        ("'engine_claims_' || operation_type", "NOT in_psp AND engine_status = 'settled'"),
        ("'psp_claims_declined'", "engine_status = 'settled' AND psp_status = 'declined'"),
        ("'psp_claims_disputed'", "engine_status = 'settled' AND psp_status = 'disputed'"),
        ("'engine_capture_not_recorded'", "engine_status = 'pending' AND psp_status = 'settled'"),
        ("'psp_claims_partial_capture'", "psp_amount_local_settled <> psp_amount_local_authorised "
         "AND engine_amount_local_settled = psp_amount_local_authorised"),
        ("'psp_claims_captured_different_period'", "engine_period IS DISTINCT FROM psp_period"),
        ("'psp_claims_duplicate_row'", "psp_amount_usd_duplicate_period <> 0 "
         "AND psp_amount_local_settled = engine_amount_local_settled"),
        ("'matched'", "gross_diff_usd = 0"),
        ("'psp_fx_date_basis'", "psp_currency = engine_currency AND psp_amount_local_settled = engine_amount_local_settled"),
        ("'psp_claims_different_amount'", "psp_currency = engine_currency AND engine_status = 'settled' AND psp_status = 'settled'"),
        ("'unexplained'", "true")) + " AS gross_cause FROM diffs",
    "classified": "SELECT *, " + ", ".join(
        f"if({s}_cause IN ('matched', 'unexplained') OR {s}_cause IS NULL, {s}_cause, 'explained') AS {s}_status"
        for s in ("bug", "net", "gross")) + " FROM caused",
    "lines": """
SELECT reporting_month, psp, 'backend_fx' AS recon_scope, bug_status AS recon_status, bug_cause AS recon_cause, bug_diff_usd AS diff_usd
FROM classified WHERE engine_in_period AND bug_cause IS NOT NULL
UNION ALL SELECT reporting_month, psp, 'gross', gross_status, gross_cause, gross_diff_usd FROM classified WHERE in_period
UNION ALL SELECT reporting_month, psp, 'fees', net_status, net_cause, net_diff_usd
FROM classified WHERE psp_in_period AND net_cause IS NOT NULL""",
    "bases": """
SELECT reporting_month, psp, 'backend_fx' AS recon_scope, 'backend booked gross' AS base_label, sum(engine_amount_usd_booked_period) AS base_usd
FROM classified WHERE engine_in_period GROUP BY ALL
UNION ALL SELECT reporting_month, psp, 'gross', 'provider gross', sum(psp_amount_usd_period + psp_amount_usd_duplicate_period)
FROM classified WHERE in_period GROUP BY ALL
UNION ALL SELECT reporting_month, psp, 'fees', 'provider fees charged', sum(coalesce(psp_fee_usd, 0))
FROM classified WHERE psp_in_period GROUP BY ALL""",
    "rollup": """
SELECT reporting_month, psp, recon_scope, recon_status, recon_cause, count(*) AS n_rows,
  CAST(sum(abs(diff_usd)) AS DECIMAL(38,2)) AS abs_usd, CAST(sum(diff_usd) AS DECIMAL(38,2)) AS signed_usd
FROM lines GROUP BY ALL""",
    "residual": """
SELECT DISTINCT reporting_month, psp, recon_scope, 'unexplained' AS recon_status, 'unexplained' AS recon_cause,
  0 AS n_rows, CAST(0 AS DECIMAL(38,2)) AS abs_usd, CAST(0 AS DECIMAL(38,2)) AS signed_usd FROM rollup r
WHERE NOT EXISTS (SELECT 1 FROM rollup u WHERE u.reporting_month IS NOT DISTINCT FROM r.reporting_month AND u.psp = r.psp
                  AND u.recon_scope = r.recon_scope AND u.recon_status = 'unexplained')""",
    "summary": f"""
WITH every AS (SELECT * FROM rollup UNION ALL SELECT * FROM residual),
based AS (
  SELECT e.*, b.base_label, b.base_usd,
    sum(e.abs_usd) OVER (PARTITION BY e.reporting_month, e.psp, e.recon_scope) AS scope_abs,
    sum(e.abs_usd) OVER (PARTITION BY e.reporting_month) AS whole_abs
  FROM every e LEFT JOIN bases b ON b.reporting_month IS NOT DISTINCT FROM e.reporting_month AND b.psp = e.psp
    AND b.recon_scope = e.recon_scope)
SELECT * EXCLUDE (scope_abs, whole_abs), {share('abs_usd', 'base_usd', 4)} AS pct_of_base,
  {share('abs_usd', 'scope_abs', 2)} AS pct_of_scope_discrepancy,
  {share('abs_usd', 'whole_abs', 2)} AS pct_of_total_discrepancy FROM based""",
    "levels": """
SELECT reporting_month, psp,
  coalesce(max(base_usd) FILTER (recon_scope = 'backend_fx'), 0) AS backend_booked,
  coalesce(sum(signed_usd) FILTER (recon_scope = 'backend_fx'), 0) AS backend_fx_faults,
  coalesce(sum(signed_usd) FILTER (recon_scope = 'gross'), 0) AS provider_variance,
  coalesce(max(base_usd) FILTER (recon_scope = 'gross'), 0) AS provider_gross,
  coalesce(max(base_usd) FILTER (recon_scope = 'fees'), 0) AS provider_fees FROM summary GROUP BY ALL""",
    "waterfall": """
WITH wide AS (
  SELECT reporting_month, psp, backend_booked, backend_fx_faults, backend_booked + backend_fx_faults AS backend_restated,
    provider_variance, provider_gross, -provider_fees AS provider_fees, provider_gross - provider_fees AS net_receipts FROM levels),
long AS (UNPIVOT wide ON backend_booked, backend_fx_faults, backend_restated, provider_variance, provider_gross,
         provider_fees, net_receipts INTO NAME line_item VALUE usd)
SELECT reporting_month, psp, list_position(['backend_booked', 'backend_fx_faults', 'backend_restated', 'provider_variance',
    'provider_gross', 'provider_fees', 'net_receipts'], line_item) AS line_seq, line_item, usd,
  line_item IN ('backend_restated', 'provider_gross', 'net_receipts') AS is_subtotal FROM long""",
}


def with_ctes(body: str, **replaced: str) -> str:
    """``body`` preceded by the relations it reads. ``replaced`` puts a changed relation in place of
    one of ours, which it may read as ``<name>_as_is``."""
    relations = dict(CTES)
    for name, sql in replaced.items():
        relations[f"{name}_as_is"] = CTES[name]
        relations[name] = sql
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
            if name in relations and name not in needed:
                visit(relations[name])
                needed.append(name)

    visit(body)
    return "WITH " + ",\n".join(f"{n} AS ({relations[n]})" for n in needed) + "\n" + body if needed else body

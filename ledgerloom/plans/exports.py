"""Provider exports and an internal payment log derived from the given order table.

Every order is a payment attempt seen by both sides. Remainders of the order key decide which kind of
disagreement is seeded on which order (a missing row is a row one side never got), so every cause of
the taxonomy occurs; nothing is sampled. Each export is a few ordinary SELECTs, one reading the other.
"""

from __future__ import annotations

from ledgerloom.plans.dialect import Dialect, pick

# named SELECTs, each reading the ones before it; the last one is the result
Steps = list[tuple[str, str]]

# Fixed values of the derived data.
PROVIDER_BY_KEY = ("adyen", "dlocal", "google_play", "paypal_eu", "paypal_us")
BASE_RATES = {  # millionths of a USD per unit
    "EUR": 1090000, "GBP": 1270000, "BRL": 185000, "MXN": 55000, "ARS": 839, "CLP": 1060, "COP": 249}
COUNTRIES = ("DE", "FR", "GB", "BR", "MX", "AR", "CL", "CO")
SKU_BY_KEY = ("sub_monthly", "sub_quarterly", "sub_annual", "coach_addon")
GOOGLE_ACCOUNT = "play_main"
CONTRACT_ROWS = (  # psp, account, valid_from, percent_fee, fixed_fee, fixed_fee_currency
    ("adyen", "SHOP_EU", "1994-01-01", "2.5", "0.00", ""),
    ("adyen", "SHOP_EU", "1998-07-01", "2.75", "0.10", "EUR"),
    ("adyen", "APP_US", "1994-01-01", "2.5", "0.00", ""),
    ("google_play", GOOGLE_ACCOUNT, "1994-01-01", "15.0", "0.00", ""),
    ("google_play", GOOGLE_ACCOUNT, "2000-01-01", "12.5", "0.00", ""),
)
CONTRACT_COLUMNS = ("psp", "account", "valid_from", "percent_fee", "fixed_fee", "fixed_fee_currency")


def fx_rates(d: Dialect) -> Steps:
    """Daily fixings per currency struck from the day's order value; some are republished."""
    codes = list(BASE_RATES)
    base = "CASE ci " + " ".join(f"WHEN {i} THEN {BASE_RATES[c]}" for i, c in enumerate(codes)) + " END"
    day = d.naive("CAST(rate_date AS DATE)")
    return [
        ("turnover", f"""SELECT CAST(o_orderdate AS DATE) AS rate_date, o_custkey % 7 AS ci,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS seed
  FROM orders GROUP BY CAST(o_orderdate AS DATE), o_custkey % 7"""),
        ("fixing", f"""SELECT rate_date, {pick('ci', codes)} AS currency, seed,
         {d.div(f'{base} * (980 + seed % 41)', '1000')} AS micro
  FROM turnover WHERE NOT ({d.weekend('rate_date')})"""),
        ("published", f"""SELECT rate_date, currency, micro, {d.each('1', 'CASE WHEN seed % 50 = 0 THEN 2 END')} AS version
  FROM fixing"""),
        ("result", f"""SELECT CAST(rate_date AS {d.string}) AS rate_date, currency,
  CAST(CAST(CAST(CASE version WHEN 1 THEN micro ELSE micro + {d.div('micro', '40')} END AS DECIMAL(18,0))
       * 0.000001 AS DECIMAL(18,6)) AS {d.string}) AS usd_rate,
  {d.show(d.plus_seconds(day, "CASE version WHEN 1 THEN 57600 ELSE 205200 END"), 'iso_z')} AS published_at
FROM published WHERE version IS NOT NULL"""),
    ]

def payments(d: Dialect) -> Steps:
    """One row per order: the attempt, before either side has recorded it."""
    k, ck = "o_orderkey", "o_custkey"
    cents = "CAST(round(o_totalprice * 100) AS BIGINT)"
    return [
        ("attempt", f"""SELECT {k} AS k, {ck} AS ck, {pick(f'{k} % 5', PROVIDER_BY_KEY)} AS psp,
    CASE {k} % 5
      WHEN 0 THEN {pick(f'{ck} % 3', ('EUR', 'GBP', 'USD'))}
      WHEN 1 THEN {pick(f'{ck} % 5', ('BRL', 'MXN', 'ARS', 'CLP', 'COP'))}
      WHEN 2 THEN {pick(f'{ck} % 5', ('EUR', 'USD', 'GBP', 'MXN', 'BRL'))}
      WHEN 3 THEN {pick(f'{ck} % 2', ('EUR', 'GBP'))}
      ELSE 'USD' END AS currency,
    {cents} AS total_cents,
    {d.plus_seconds(d.naive('o_orderdate'), f'({k} * 7919) % 86400')} AS created_at
  FROM orders"""),
        ("result", f"""SELECT k, ck, psp, currency,
  {pick('ck % 8', COUNTRIES)} AS country, {pick(f"{d.div('k', '5')} % 4", SKU_BY_KEY)} AS sku,
  CASE WHEN ck % 2 = 0 THEN 'SHOP_EU' ELSE 'APP_US' END AS adyen_account,
  CASE currency WHEN 'CLP' THEN 100 ELSE 1 END AS unit,
  CASE currency WHEN 'CLP' THEN {d.div('total_cents', '100')} * 100 ELSE total_cents END AS cents,
  created_at, {d.plus_seconds('created_at', '300 + (k * 17) % 6007')} AS captured_at,
  {d.plus_seconds('created_at', '864300 + (k * 17) % 6007')} AS reversed_at
FROM attempt"""),
    ]

def provider_view(d: Dialect) -> Steps:
    """What the provider recorded of each payment. Reads ``payments``."""
    half = f"{d.div('moved_cents', '2 * unit')} * unit"
    return [
        ("decided", f"""SELECT *, CASE WHEN k % 73 = 21 THEN 'absent'
                 WHEN k % 13 = 1 OR k % 67 = 16 THEN 'declined'
                 WHEN k % 61 = 15 AND psp = 'dlocal' THEN 'disputed'
                 ELSE 'settled' END AS outcome
  FROM payments"""),
        ("sized", f"""SELECT *, CASE WHEN outcome = 'settled' AND k % 53 = 18 THEN cents + 500 ELSE cents END AS asked_cents,
    CASE WHEN k % 31 = 20 AND psp <> 'google_play' THEN 3024000 ELSE 0 END AS delay
  FROM decided"""),
        ("moved", f"""SELECT *, CASE WHEN psp = 'adyen' AND k % 59 = 17 THEN {d.div('asked_cents * 60', '100')}
                 ELSE asked_cents END AS moved_cents,
    {d.plus_seconds('captured_at', 'delay')} AS settled_at,
    {d.plus_seconds('reversed_at', 'delay')} AS undone_at,
    CASE WHEN outcome <> 'settled' THEN NULL
         WHEN k % 331 = 8 AND psp IN ('adyen', 'paypal_eu', 'paypal_us') THEN 'chargeback'
         WHEN k % 41 = 7 THEN 'refund' END AS reversal,
    CASE WHEN k % 83 = 22 THEN 50 WHEN k % 109 = 23 THEN -25 ELSE 0 END AS fee_error
  FROM sized"""),
        ("result", f"""SELECT *, {half} AS undone_cents FROM moved"""),
    ]

def adyen(d: Dialect) -> Steps:
    """Reads ``provider_view``."""
    fee = (f"{d.div('moved_cents * bp + 5000', '10000')} + fixed_cents + fee_error")
    when = d.in_zone("CASE entry WHEN 'Settled' THEN settled_at WHEN 'Authorised' THEN created_at "
                     "WHEN 'Refused' THEN created_at ELSE undone_at END", "Europe/Amsterdam")
    settled = "entry = 'Settled'"
    return [
        ("entries", f"""SELECT *, {d.each("CASE WHEN outcome = 'settled' THEN 'Authorised' END",
                    "CASE WHEN outcome = 'settled' THEN 'Settled' END",
                    "CASE WHEN outcome = 'declined' THEN 'Refused' END",
                    "CASE reversal WHEN 'refund' THEN 'Refunded' WHEN 'chargeback' THEN 'Chargeback' END")} AS entry,
    adyen_account = 'SHOP_EU' AND CAST(settled_at AS DATE) >= DATE '1998-07-01' AS new_terms
  FROM provider_view WHERE psp = 'adyen'"""),
        ("charged", f"""SELECT *, CASE WHEN new_terms THEN 275 ELSE 250 END AS bp,
    CASE WHEN new_terms AND currency = 'EUR' THEN 10 ELSE 0 END AS fixed_cents
  FROM entries WHERE entry IS NOT NULL"""),
        ("fees", f"""SELECT *, {fee} AS fee_cents FROM charged"""),
        ("result", f"""SELECT adyen_account AS `Merchant Account`, concat('A-', CAST(k AS {d.string})) AS `Psp Reference`,
  concat('ORD-', CAST(k AS {d.string})) AS `Merchant Reference`, entry AS `Record Type`,
  {d.show(when, 'iso')} AS `Creation Date`, currency AS `Gross Currency`,
  CASE WHEN {settled} THEN {d.money_text('moved_cents')}
       WHEN entry IN ('Authorised', 'Refused') THEN {d.money_text('asked_cents')} END AS `Gross Credit`,
  CASE WHEN entry IN ('Refunded', 'Chargeback') THEN {d.money_text('undone_cents')} END AS `Gross Debit`,
  CASE WHEN {settled} THEN {d.money_text(d.div('fee_cents', '3'))} END AS `Commission`,
  CASE WHEN {settled} THEN {d.money_text(f"fee_cents - {d.div('fee_cents', '3')}")} END AS `Markup`,
  CASE WHEN {settled} THEN {d.money_text('moved_cents - fee_cents')} END AS `Net Credit`,
  CASE WHEN entry IN ('Refunded', 'Chargeback') THEN {d.money_text('undone_cents')} END AS `Net Debit`,
  CAST(k % 28 AS {d.string}) AS `Batch Number`
FROM fees"""),
    ]

def dlocal(d: Dialect) -> Steps:
    """Reads ``provider_view`` with ``captured_rate``, the rate in force on the capture date."""
    sale = "entry = 'PAYMENT'"
    amount = "CASE entry WHEN 'PAYMENT' THEN asked_cents ELSE undone_cents END"
    return [
        ("entries", f"""SELECT *, {d.each("CASE WHEN outcome <> 'absent' THEN 'PAYMENT' END",
                    "CASE WHEN outcome <> 'absent' AND k % 79 = 19 THEN 'PAYMENT' END",
                    "CASE WHEN reversal = 'refund' THEN 'REFUND' END")} AS entry,
    CAST(captured_rate * 1000000 AS BIGINT) AS micro
  FROM provider_view WHERE psp = 'dlocal'"""),
        ("quoted", f"""SELECT *, {amount} AS amount_cents, {d.div(f"1000000000000 + {d.div('micro', '2')}", 'micro')} AS per_usd
  FROM entries WHERE entry IS NOT NULL"""),
        ("dollars", f"""SELECT *, {d.div('amount_cents * 2000000 + per_usd', '2 * per_usd')} AS usd_cents FROM quoted"""),
        ("result", f"""SELECT concat(CASE WHEN {sale} THEN 'D-' ELSE 'DR-' END, CAST(k AS {d.string})) AS transaction_id,
  concat('ORD-', CAST(k AS {d.string})) AS invoice_id, entry AS transaction_type,
  CASE WHEN entry = 'REFUND' THEN 'REFUNDED' WHEN outcome = 'declined' THEN 'REJECTED'
       WHEN outcome = 'disputed' THEN 'IN_MEDIATION' ELSE 'PAID' END AS status,
  {d.show("CASE WHEN entry = 'REFUND' THEN undone_at WHEN outcome = 'declined' THEN created_at "
          "ELSE settled_at END", 'iso')} AS created_at_utc,
  country, currency, CASE currency WHEN 'CLP' THEN '0' ELSE '2' END AS currency_exponent,
  CAST({d.div('amount_cents', 'unit')} AS {d.string}) AS local_amount,
  CAST(CAST(CAST(per_usd AS DECIMAL(18,0)) * 0.000001 AS DECIMAL(18,6)) AS {d.string}) AS fx_rate,
  {d.money_text('usd_cents')} AS usd_amount,
  CASE WHEN {sale} THEN {d.money_text(d.div('usd_cents * 45', '1000'))} ELSE '0.00' END AS fee_usd
FROM dollars"""),
    ]

def google_play(d: Dialect) -> Steps:
    """Reads ``provider_view`` with ``captured_rate``. Carries the file each line belongs to: the
    ledger is cut into files on local dates."""
    when = d.in_zone("CASE entry WHEN 'Charge refund' THEN undone_at ELSE settled_at END", "America/Los_Angeles")
    local = f"CAST(CASE currency WHEN 'USD' THEN 1 ELSE captured_rate END AS DECIMAL(18,6))"
    return [
        ("entries", f"""SELECT *, {d.each("CASE WHEN outcome = 'settled' THEN 'Charge' END",
                    "CASE WHEN outcome = 'settled' THEN 'Google fee' END",
                    "CASE WHEN reversal = 'refund' THEN 'Charge refund' END")} AS entry,
    CASE WHEN CAST(settled_at AS DATE) >= DATE '2000-01-01' THEN 1250 ELSE 1500 END AS bp, {local} AS rate
  FROM provider_view WHERE psp = 'google_play'"""),
        ("dollars", f"""SELECT *, {when} AS local_at,
    CAST(round(CAST(moved_cents AS DECIMAL(18,0)) * rate, 0) AS BIGINT) AS sale_usd_cents,
    CAST(round(CAST(undone_cents AS DECIMAL(18,0)) * rate, 0) AS BIGINT) AS undone_usd_cents
  FROM entries WHERE entry IS NOT NULL"""),
        ("amounts", f"""SELECT *,
    CASE entry WHEN 'Charge' THEN moved_cents WHEN 'Charge refund' THEN -undone_cents
         ELSE -({d.div('moved_cents * bp + 5000', '10000')} + fee_error) END AS amount_cents,
    CASE entry WHEN 'Charge' THEN sale_usd_cents WHEN 'Charge refund' THEN -undone_usd_cents
         ELSE -({d.div('sale_usd_cents * bp + 5000', '10000')} + fee_error) END AS usd_cents
  FROM dollars"""),
        ("result", f"""SELECT {d.show('local_at', 'worded')} AS `Transaction Date`, {d.show('local_at', 'clock')} AS `Transaction Time`,
  entry AS `Transaction Type`, sku AS `Product ID`, country AS `Buyer Country`, currency AS `Buyer Currency`,
  {d.money_text('amount_cents')} AS `Amount (Buyer Currency)`,
  CAST(rate AS {d.string}) AS `Currency Conversion Rate`, 'USD' AS `Merchant Currency`,
  {d.money_text('usd_cents')} AS `Amount (Merchant Currency)`,
  CASE WHEN CAST(local_at AS DATE) < DATE '1998-07-01' THEN 'early' ELSE 'late' END AS part
FROM amounts"""),
    ]

def paypal(d: Dialect) -> Steps:
    """Reads ``provider_view``. Both accounts, each in its own dialect, with the month of its file."""
    def amount(cents: str) -> str:
        return (f"CASE psp WHEN 'paypal_eu' THEN replace({d.money_text(cents)}, '.', ',') "
                f"ELSE {d.money_text(cents)} END")

    day_first = "psp = 'paypal_eu' AND k % 401 <> 24"
    return [
        ("entries", f"""SELECT *, {d.each("CASE WHEN outcome IN ('settled', 'declined') THEN 'sale' END",
                    "CASE WHEN outcome IN ('settled', 'declined') AND k % 79 = 19 THEN 'sale' END",
                    "reversal")} AS entry
  FROM provider_view WHERE psp IN ('paypal_eu', 'paypal_us')"""),
        ("amounts", f"""SELECT *, CASE entry WHEN 'sale' THEN asked_cents ELSE -undone_cents END AS gross_cents,
    CASE WHEN entry <> 'sale' OR outcome <> 'settled' THEN 0
         WHEN currency = 'USD' THEN {d.div('moved_cents * 349 + 5000', '10000')} + 49 + fee_error
         WHEN currency = 'EUR' THEN {d.div('moved_cents * 290 + 5000', '10000')} + 35 + fee_error
         ELSE {d.div('moved_cents * 290 + 5000', '10000')} + 30 + fee_error END AS fee_cents,
    CASE WHEN entry <> 'sale' THEN undone_at WHEN outcome = 'declined' THEN created_at ELSE settled_at END AS event_at
  FROM entries WHERE entry IS NOT NULL"""),
        ("result", f"""SELECT psp AS account,
  CASE WHEN {day_first} THEN {d.show('event_at', 'dmy')} ELSE {d.show('event_at', 'mdy')} END AS `Date`,
  {d.show('event_at', 'clock')} AS `Time`, 'GMT' AS `Time Zone`,
  CASE entry WHEN 'sale' THEN 'Website Payment' WHEN 'refund' THEN 'Refund' ELSE 'Payment Reversal' END AS `Type`,
  CASE WHEN entry = 'refund' THEN 'Refunded' WHEN entry = 'chargeback' THEN 'Reversed'
       WHEN outcome = 'declined' THEN 'Denied' ELSE 'Completed' END AS `Status`,
  currency AS `Currency`, {amount('gross_cents')} AS `Gross`, {amount('-fee_cents')} AS `Fee`,
  CASE WHEN outcome = 'declined' THEN {amount('0')} ELSE {amount('gross_cents - fee_cents')} END AS `Net`,
  concat(CASE entry WHEN 'sale' THEN 'PP-' ELSE 'PPR-' END, CAST(k AS {d.string})) AS `Transaction ID`,
  CASE entry WHEN 'sale' THEN '' ELSE concat('PP-', CAST(k AS {d.string})) END AS `Reference Txn ID`,
  concat('ORD-', CAST(k AS {d.string})) AS `Invoice ID`,
  CAST({d.month_start('event_at')} AS {d.string}) AS export_month
FROM amounts"""),
    ]

def payment_log(d: Dialect) -> Steps:
    """Reads ``payments`` with the rates in force on creation and on reversal, and the rate before."""
    half = f"{d.div('cents', '2 * unit')} * unit"
    reference = f"concat(CASE WHEN entry = 'SALE' THEN 'X-' ELSE 'XR-' END, CAST(k AS {d.string}))"
    return [
        ("decided", f"""SELECT *, CASE WHEN k % 71 = 9 THEN 'absent' WHEN k % 89 = 11 THEN 'PENDING'
                 WHEN k % 13 = 1 THEN 'DECLINED' ELSE 'SETTLED' END AS outcome
  FROM payments"""),
        ("entries", f"""SELECT *, {d.each("CASE WHEN outcome <> 'absent' THEN 'SALE' END",
                    "CASE WHEN outcome <> 'SETTLED' OR k % 3 = 0 THEN NULL "
                    "WHEN k % 331 = 8 AND psp IN ('adyen', 'paypal_eu', 'paypal_us') THEN 'CHARGEBACK' "
                    "WHEN k % 41 = 7 THEN 'REFUND' END")} AS entry
  FROM decided"""),
        ("dated", f"""SELECT *, CASE entry WHEN 'SALE' THEN created_at ELSE reversed_at END AS entry_at,
    CASE entry WHEN 'SALE' THEN cents ELSE {half} END AS amount_cents,
    CASE entry WHEN 'SALE' THEN created_rate ELSE reversed_rate END AS right_rate,
    CASE entry WHEN 'SALE' THEN created_rate_date ELSE reversed_rate_date END AS right_date
  FROM entries WHERE entry IS NOT NULL"""),
        ("booked", f"""SELECT *, CAST(CASE WHEN currency = 'USD' OR right_rate IS NULL OR k % 37 = 2 THEN 1
                 WHEN k % 41 = 3 THEN round(right_rate * 1.01, 6)
                 WHEN k % 43 = 4 AND entry = 'SALE' THEN coalesce(previous_rate, right_rate)
                 ELSE right_rate END AS DECIMAL(18,6)) AS rate,
    CASE WHEN currency = 'USD' OR right_rate IS NULL THEN CAST(entry_at AS DATE)
         WHEN k % 47 = 5 THEN DATE '1990-01-01'
         WHEN k % 43 = 4 AND entry = 'SALE' THEN coalesce(previous_date, right_date)
         ELSE right_date END AS rate_date
  FROM dated"""),
        ("result", f"""SELECT concat(CASE entry WHEN 'SALE' THEN 'T-' ELSE 'TR-' END, CAST(k AS {d.string})) AS txn_id,
  concat('ORD-', CAST(k AS {d.string})) AS order_id, entry AS operation_type, outcome AS status, psp,
  CASE WHEN psp <> 'google_play' THEN {reference} END AS psp_reference,
  sku, country, currency, {d.money_text('amount_cents')} AS amount_local,
  CAST(rate AS {d.string}) AS fx_rate_applied, CAST(rate_date AS {d.string}) AS fx_date_applied,
  CAST(CAST(round({d.money('amount_cents')} * rate, 2) AS DECIMAL(18,2)) AS {d.string}) AS amount_usd,
  {d.show("entry_at", "iso")} AS created_at_utc,
  CASE WHEN outcome = 'SETTLED' THEN
    {d.show("CASE entry WHEN 'SALE' THEN captured_at ELSE reversed_at END", 'iso')} END AS captured_at_utc
FROM booked"""),
    ]

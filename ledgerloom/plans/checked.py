"""Registered quality checks. Each runs over the derived layers with a seeded fault where the layers
have none of their own, so a check that could never fire would be noticed."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import quality as Q
from ledgerloom.operators import refdata, staging
from ledgerloom.plans.derived import Derived
from ledgerloom.plans.queries import QUERIES, register

CENT = Decimal("0.01")
__all__ = ["QUERIES"]  # with the checks of this module registered


def nudged(df: DataFrame, column: str, by: str, where: str) -> DataFrame:
    """Add ``by`` to a money column on the rows that meet a condition."""
    value = F.when(F.expr(where), F.col(column) + F.lit(Decimal(by))).otherwise(F.col(column))
    return df.withColumn(column, value.cast(df.schema[column].dataType))


def _nudge(relation: str, column: str, by: str, where: str) -> str:
    return (f"SELECT * REPLACE (if({where}, {column} + {by}, {column}) AS {column}) FROM {relation}_as_is")


def check(name: str, build: Callable[[Derived], DataFrame], columns: str, sql: str, **replaced: str) -> None:
    register(f"dq_{name}", build, columns, sql, **replaced)


# --- generic column checks ---

_BROKEN_LEDGER = ("SELECT * REPLACE (CASE WHEN sku <> 'coach_addon' THEN country END AS country, "
                  "if(status = 'pending', 'PENDING', status) AS status, if(currency = 'CLP', 'XXX', currency) AS currency) "
                  "FROM ledger_as_is")


def _broken_ledger(x: Derived) -> DataFrame:
    return x.ledger.withColumns({
        "country": F.when(F.col("sku") != "coach_addon", F.col("country")),
        "status": F.when(F.col("status") == "pending", "PENDING").otherwise(F.col("status")),
        "currency": F.when(F.col("currency") == "CLP", "XXX").otherwise(F.col("currency"))})


check("not_null", lambda x: Q.not_null(_broken_ledger(x), Q.COLUMN_CHECKS["ledger"][0]), "column_name n_rows:i",
      "SELECT 'country' AS column_name, count(*) AS n_rows FROM ledger WHERE country IS NULL", ledger=_BROKEN_LEDGER)
check("unique", lambda x: Q.unique(x.dlocal_raw, "transaction_id"), "column_name value n_rows:i",
      "SELECT 'transaction_id' AS column_name, transaction_id AS value, count(*) AS n_rows FROM dlocal_raw "
      "GROUP BY ALL HAVING count(*) > 1")
check("accepted_values", lambda x: Q.accepted_values(_broken_ledger(x), Q.COLUMN_CHECKS["ledger"][2]),
      "column_name value n_rows:i",
      "SELECT 'status' AS column_name, status AS value, count(*) AS n_rows FROM ledger WHERE status = 'PENDING' GROUP BY ALL "
      "UNION ALL SELECT 'currency', currency, count(*) FROM ledger WHERE currency = 'XXX' GROUP BY ALL", ledger=_BROKEN_LEDGER)
check("column_suite_ledger", lambda x: Q.column_checks("ledger", _broken_ledger(x)),
      "table_name rule column_name value n_rows:i",
      "SELECT 'ledger' AS table_name, 'not_null' AS rule, 'country' AS column_name, CAST(NULL AS VARCHAR) AS value, "
      "count(*) AS n_rows FROM ledger WHERE country IS NULL "
      "UNION ALL SELECT 'ledger', 'accepted_values', 'status', status, count(*) FROM ledger WHERE status = 'PENDING' GROUP BY ALL "
      "UNION ALL SELECT 'ledger', 'accepted_values', 'currency', currency, count(*) FROM ledger WHERE currency = 'XXX' GROUP BY ALL",
      ledger=_BROKEN_LEDGER)

# The other tables: some rows lose a value that must be filled, others get one that is not on the list. A column,
# when it is emptied, a column and when it is strayed from, in words both sides read; and the tables' own names.
_SUITES: dict[str, tuple[str, str, str | None, str, Callable[[Derived], DataFrame], str]] = {
    "fx_rates": ("published_at", "rate_version > 1", "currency", "usd_rate > 5", lambda x: x.rate_versions, "rate_versions"),
    "fee_schedule": ("fixed_fee", "psp = 'adyen'", None, "", lambda x: refdata.fee_contracts(x.contracts_raw), "contracts"),
    "adyen": ("psp_reference", "operation_type = 'refund'", "status", "amount_local > 500", lambda x: x.adyen, "adyen"),
    "dlocal": ("order_ref", "currency = 'BRL'", "operation_type", "status = 'declined'", lambda x: x.dlocal, "dlocal"),
    "google_play": ("psp_account", "operation_type = 'refund'", "status", "amount_local > 500", lambda x: x.google_play, "google_play"),
    "paypal": ("fee_local", "status = 'declined'", "psp", "operation_type = 'refund'", lambda x: x.paypal, "paypal"),
    "restated": ("amount_usd_recon", "currency = 'EUR'", "fx_variance_reason", "currency = 'BRL'", lambda x: x.restated, "restated"),
    "providers": ("recognised_at_utc", "operation_type = 'refund'", None, "", lambda x: x.providers, "providers"),
    "matched": ("diff_usd", "NOT in_engine", "operation_type", "NOT in_psp", lambda x: x.matched, "matched"),
    "classified": ("gross_diff_usd", "NOT in_engine", "bug_status", "psp = 'dlocal'", lambda x: x.classified, "classified"),
    "summary": ("base_label", "recon_scope = 'fees'", "recon_status", "n_rows > 100", lambda x: x.summary, "summary"),
    "waterfall": ("usd", "is_subtotal", "line_item", "psp = 'adyen'", lambda x: x.waterfall, "waterfall"),
}


def _seeded(x: Derived, table: str) -> DataFrame:
    emptied, empty_if, strayed, stray_if, build, _ = _SUITES[table]
    # Both conditions read the columns as they were, as the SQL does.
    df = build(x).withColumns({"__empty": F.expr(empty_if), "__stray": F.expr(stray_if or "false")})
    df = df.withColumn(emptied, F.when(~F.coalesce("__empty", F.lit(False)), F.col(emptied)))
    if strayed:
        df = df.withColumn(strayed, F.when(F.coalesce("__stray", F.lit(False)), "XXX").otherwise(F.col(strayed)))
    return df.drop("__empty", "__stray")


def _suite_sql(table: str) -> tuple[str, dict[str, str]]:
    emptied, empty_if, strayed, stray_if, _, name = _SUITES[table]
    filled, distinct, accepted = Q.COLUMN_CHECKS[table]
    seeds = [f"if(coalesce({empty_if}, false), NULL, {emptied}) AS {emptied}"]
    seeds += [f"if(coalesce({stray_if}, false), 'XXX', {strayed}) AS {strayed}"] if strayed else []

    def found(rule: str, column: str, value: str, where: str, having: str = "HAVING count(*) > 0") -> str:
        return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, {value} AS value, count(*) AS n_rows "
                f"FROM {name} WHERE {where} GROUP BY ALL {having}")

    def listed(values: tuple) -> str:
        return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)

    arms = [found("not_null", c, "CAST(NULL AS VARCHAR)", f"{c} IS NULL") for c in filled]
    arms += [found("unique", c, f"CAST({c} AS VARCHAR)", f"{c} IS NOT NULL", "HAVING count(*) > 1") for c in distinct]
    arms += [found("accepted_values", c, f"CAST({c} AS VARCHAR)", f"{c} NOT IN ({listed(values)})") for c, values in accepted.items()]
    return " UNION ALL ".join(arms), {name: f"SELECT * REPLACE ({', '.join(seeds)}) FROM {name}_as_is"}


for _table in _SUITES:
    _sql, _replaced = _suite_sql(_table)
    check(f"column_suite_{_table}", lambda x, table=_table: Q.column_checks(table, _seeded(x, table)),
          "table_name rule column_name value n_rows:i", _sql, **_replaced)

# --- raw against staged ---

check("authorised_not_double_counted",
      lambda x: Q.authorised_not_double_counted(x.adyen_raw, x.adyen.unionByName(x.adyen)), "raw_n:i staged_n:i",
      "SELECT count(*) AS raw_n, 2 * count(*) AS staged_n FROM adyen_raw WHERE \"Record Type\" = 'Settled'")
check("repeated_lines_identical",
      lambda x: Q.repeated_lines_are_identical(x.dlocal_raw.unionByName(
          x.dlocal_raw.filter("status = 'REJECTED'").withColumn("fee_usd", F.lit("9.99")))),
      "transaction_id transaction_type n_distinct_rows:i",
      "SELECT transaction_id, transaction_type, count(*) AS n_distinct_rows FROM (SELECT * FROM dlocal_raw UNION "
      "SELECT * REPLACE ('9.99' AS fee_usd) FROM dlocal_raw WHERE status = 'REJECTED') GROUP BY ALL HAVING count(*) > 1")



def _blanket_exponent(x: Derived) -> DataFrame:
    raw = x.dlocal_raw.withColumn("currency_exponent", F.lit("2"))
    return Q.minor_units_scaled(raw, staging.dlocal(raw))


check("minor_units_scaled", _blanket_exponent,
      "psp_reference currency amount_local:m usd_amount_reported:m fx_rate_local_per_usd:m",
      """SELECT transaction_id AS psp_reference, currency, CAST(local_amount AS DECIMAL(18,2)) * 0.01 AS amount_local,
         CAST(usd_amount AS DECIMAL(18,2)) AS usd_amount_reported, CAST(fx_rate AS DECIMAL(18,6)) AS fx_rate_local_per_usd
         FROM (SELECT DISTINCT * FROM dlocal_raw) WHERE abs(CAST(usd_amount AS DECIMAL(18,2))
           - round(CAST(local_amount AS DECIMAL(18,2)) * 0.01 / CAST(fx_rate AS DECIMAL(18,6)), 2)) > 0.01""")
check("fee_rows_folded",
      lambda x: Q.fee_rows_folded(x.google_play_raw.filter(
          "not (`Transaction Type` = 'Google fee' and `Product ID` = 'coach_addon')")),
      "event_ts sku country n_charge:i n_fee:i",
      """SELECT "Transaction Date" || ' ' || "Transaction Time" AS event_ts, "Product ID" AS sku, "Buyer Country" AS country,
         count(*) FILTER ("Transaction Type" = 'Charge') AS n_charge,
         count(*) FILTER ("Transaction Type" = 'Google fee' AND "Product ID" <> 'coach_addon') AS n_fee
         FROM google_play_raw GROUP BY ALL HAVING n_charge <> n_fee""")
check("timezone_converted", lambda x: Q.timezone_converted(x.google_play, x.ledger), "match_key created_at_utc:t",
      """SELECT g.match_key, g.created_at_utc FROM google_play g LEFT JOIN ledger l ON l.psp = 'google_play'
         AND l.captured_at_utc = g.created_at_utc AND l.sku = split_part(g.match_key, '|', 2)
         AND l.country = split_part(g.match_key, '|', 3) AND l.operation_type = g.operation_type WHERE l.txn_id IS NULL""")
# Some of the orders whose date is read the other way are not pinned.
_PINNED = "psp = 'paypal_eu' AND k % 401 = 24 AND k % 3 <> 0"
check("date_override_bounded",
      lambda x: Q.date_override_bounded(x.paypal, x.payments.filter(_PINNED).select(
          F.concat(F.lit("ORD-"), F.col("k").cast("string")).alias("order_ref"))),
      "psp order_ref psp_reference created_at_utc:t",
      f"""SELECT * FROM (WITH pinned AS (SELECT 'ORD-' || k AS order_ref FROM payments WHERE {_PINNED}),
         seen AS (SELECT * FROM paypal WHERE date_format_overridden)
         SELECT psp, order_ref, psp_reference, created_at_utc FROM seen WHERE order_ref NOT IN (SELECT order_ref FROM pinned)
         UNION ALL SELECT 'expected_override_count', CAST(n AS VARCHAR), NULL, NULL FROM (SELECT count(*) AS n FROM seen)
         WHERE n <> (SELECT count(*) FROM pinned))""")
check("declared_zone_is_gmt",
      lambda x: Q.declared_zone_is_gmt(x.paypal_raw.withColumn(
          "Time Zone", F.when(F.col("Currency") == "GBP", "PST").otherwise(F.col("Time Zone")))),
      "declared_time_zone n_rows:i",
      """SELECT 'PST' AS declared_time_zone, count(*) AS n_rows FROM paypal_raw WHERE "Currency" = 'GBP' """)
check("paypal_fee_is_tariff", lambda x: Q.paypal_fee_is_tariff(x.paypal),
      "psp order_ref currency amount_local_settled:m fee_local:m",
      """SELECT psp, order_ref, currency, amount_local_settled, fee_local FROM paypal WHERE operation_type = 'sale'
         AND status = 'settled' AND fee_local <> round(amount_local_settled * if(currency = 'USD', 0.0349, 0.0290), 2)
           + map {'USD': 0.49, 'EUR': 0.35, 'GBP': 0.30}[currency]""")
check("reversals_resolve",
      lambda x: Q.reversals_resolve(x.paypal.withColumn("related_psp_reference", F.when(
          F.col("currency") != "GBP", F.col("related_psp_reference")))),
      "psp order_ref psp_reference related_psp_reference",
      """SELECT r.psp, r.order_ref, r.psp_reference, r.related_psp_reference FROM paypal r LEFT JOIN paypal s
         ON s.psp = r.psp AND s.psp_reference = r.related_psp_reference WHERE r.operation_type <> 'sale'
         AND (s.psp IS NULL OR s.operation_type <> 'sale' OR s.status <> 'settled' OR s.order_ref <> r.order_ref
              OR abs(r.amount_local) > s.amount_local OR r.created_at_utc < s.created_at_utc)""",
      paypal="SELECT * REPLACE (CASE WHEN currency <> 'GBP' THEN related_psp_reference END AS related_psp_reference) FROM paypal_as_is")

# --- the ledger and the rates ---

_CAPTURES = ("SELECT * REPLACE (CASE WHEN status = 'declined' THEN created_at_utc WHEN sku = 'coach_addon' THEN NULL "
             "ELSE captured_at_utc END AS captured_at_utc) FROM ledger_as_is")
check("capture_completeness",
      lambda x: Q.capture_completeness(x.ledger.withColumn("captured_at_utc", F.when(
          F.col("status") == "declined", F.col("created_at_utc")).when(F.col("sku") != "coach_addon", F.col("captured_at_utc")))),
      "txn_id status captured_at_utc:t",
      "SELECT * FROM ledger WHERE (captured_at_utc IS NULL) <> (status <> 'settled') OR captured_at_utc < created_at_utc",
      ledger=_CAPTURES)
check("reference_coverage",
      lambda x: Q.reference_coverage(x.ledger.withColumn("psp_reference", F.when(
          F.col("country") == "DE", F.lit("Y")).when(F.col("country") != "FR", F.col("psp_reference")))),
      "txn_id psp psp_reference",
      "SELECT * FROM ledger WHERE (psp = 'google_play') = (psp_reference IS NOT NULL)",
      ledger="SELECT * REPLACE (CASE country WHEN 'DE' THEN 'Y' WHEN 'FR' THEN NULL ELSE psp_reference END AS psp_reference) FROM ledger_as_is")
check("booked_usd_reproducible",
      lambda x: Q.booked_usd_reproducible(nudged(x.ledger, "amount_usd", "0.01", "fx_rate_applied = 1 and currency <> 'USD'")),
      "txn_id amount_local:m fx_rate_applied:m amount_usd:m amount_usd_recomputed:m",
      "SELECT *, round(CAST(amount_local AS DECIMAL(28,2)) * fx_rate_applied, 2) AS amount_usd_recomputed FROM ledger "
      "WHERE amount_usd <> round(CAST(amount_local AS DECIMAL(28,2)) * fx_rate_applied, 2)",
      ledger=_nudge("ledger", "amount_usd", "0.01", "fx_rate_applied = 1 AND currency <> 'USD'"))
check("fx_correction_arithmetic",
      lambda x: Q.fx_correction_arithmetic(nudged(x.restated, "amount_usd_recon", "0.01", "fx_variance_reason = 'fx_date_stale'")),
      "txn_id fx_variance_reason amount_local:m fx_rate_expected:m amount_usd_engine:m amount_usd_recon:m",
      "SELECT * FROM restated WHERE amount_usd_recon <> round(CAST(amount_local AS DECIMAL(28,2)) * fx_rate_expected, 2)",
      restated=_nudge("restated", "amount_usd_recon", "0.01", "fx_variance_reason = 'fx_date_stale'"))
check("fx_join_preserves_grain",
      lambda x: Q.grain_preserved(x.ledger, x.ledger.join(
          x.rate_versions.select(F.col("rate_date").alias("fx_date_applied"), "currency"), ["fx_date_applied", "currency"], "left")),
      "n_before:i n_after:i",
      "SELECT * FROM (SELECT count(*) AS n_before FROM ledger), (SELECT count(*) AS n_after FROM ledger l LEFT JOIN rate_versions r "
      "ON r.rate_date = l.fx_date_applied AND r.currency = l.currency) WHERE n_before <> n_after")
check("fx_rates_grain", lambda x: Q.rate_grain(x.rate_versions.unionByName(x.rate_versions.filter("rate_version = 2"))),
      "rate_date:d currency rate_version:i n_rows:i",
      "SELECT rate_date, currency, rate_version, 2 AS n_rows FROM rate_versions WHERE rate_version = 2")

# --- the reconciliation ---

_ROW = "reporting_month:d psp match_key operation_type"
check("fixed_fee_currency_handled", lambda x: Q.fixed_fee_currency_handled(x.classified),
      "psp order_ref psp_currency fixed_fee:m fixed_fee_currency",
      "SELECT * FROM classified WHERE fixed_fee <> 0 AND fixed_fee_currency <> psp_currency")
check("net_ties_to_gross_less_fees",
      lambda x: Q.net_ties_to_gross_less_fees(nudged(x.providers, "net_local", "0.01", "operation_type = 'refund'")),
      "psp order_ref operation_type amount_local_settled:m fee_local:m net_local:m",
      "SELECT * FROM providers WHERE net_local <> amount_local_settled - fee_local",
      providers=_nudge("providers", "net_local", "0.01", "operation_type = 'refund'"))
check("recon_grain", lambda x: Q.recon_grain(x.matched.unionByName(x.matched.filter("not in_psp"))),
      "psp match_key operation_type n_rows:i",
      "SELECT psp, match_key, operation_type, count(*) AS n_rows FROM (SELECT * FROM matched UNION ALL "
      "SELECT * FROM matched WHERE NOT in_psp) GROUP BY ALL HAVING count(*) > 1")
check("matched_rows_agree", lambda x: Q.matched_rows_agree(x.classified), f"{_ROW} engine_status psp_status diff_local:m",
      "SELECT * FROM classified WHERE gross_cause = 'matched' AND (NOT (in_engine AND in_psp) OR engine_status <> psp_status "
      "OR engine_currency <> psp_currency OR diff_local <> 0 OR diff_usd <> 0)")
check("matched_fees_agree", lambda x: Q.matched_fees_agree(nudged(x.classified, "net_diff_usd", "0.01", "psp = 'google_play'")),
      f"{_ROW} net_diff_usd:m", "SELECT * FROM classified WHERE net_cause = 'matched' AND net_diff_usd <> 0",
      classified=_nudge("classified", "net_diff_usd", "0.01", "psp = 'google_play'"))
check("fee_verdict_on_settled_sales",
      lambda x: Q.fee_verdict_on_settled_sales(x.classified.withColumn("net_cause", F.when(
          F.col("net_cause") != "psp_fee_overcharge", F.col("net_cause")))),
      "psp order_ref operation_type psp_status net_cause",
      "SELECT * FROM classified WHERE settled_sale <> (net_cause IS NOT NULL)",
      classified="SELECT * REPLACE (nullif(net_cause, 'psp_fee_overcharge') AS net_cause) FROM classified_as_is")


def _unbucketed(x: Derived) -> DataFrame:
    return x.classified.withColumn("gross_status", F.when(
        F.col("gross_cause") != "psp_claims_disputed", F.col("gross_status")))


check("buckets_reconcile", lambda x: Q.buckets_reconcile(_unbucketed(x)),
      "reporting_month:d psp recon_scope matched_usd:m explained_usd:m unexplained_usd:m control_usd:m",
      """SELECT * FROM (SELECT reporting_month, psp, recon_scope,
           coalesce(sum(diff_usd) FILTER (recon_status = 'matched'), 0) AS matched_usd,
           coalesce(sum(diff_usd) FILTER (recon_status = 'explained' AND recon_cause <> 'psp_claims_disputed'), 0) AS explained_usd,
           coalesce(sum(diff_usd) FILTER (recon_status = 'unexplained'), 0) AS unexplained_usd, sum(diff_usd) AS control_usd
         FROM lines WHERE recon_scope = 'gross' GROUP BY ALL)
         WHERE abs(matched_usd + explained_usd + unexplained_usd - control_usd) > 0.005""")
check("waterfall_closes", lambda x: Q.waterfall_closes(nudged(x.classified, "gross_diff_usd", "1", "gross_cause = 'psp_claims_declined'")),
      "reporting_month:d psp booked_usd:m bugs_usd:m gross_usd:m psp_usd:m",
      """SELECT reporting_month, psp, sum(engine_amount_usd_booked_period) AS booked_usd, sum(bug_diff_usd) AS bugs_usd,
           sum(gross_diff_usd) AS gross_usd, sum(psp_amount_usd_period + psp_amount_usd_duplicate_period) AS psp_usd
         FROM classified WHERE in_period GROUP BY ALL HAVING abs(booked_usd + bugs_usd + gross_usd - psp_usd) > 0.005""",
      classified=_nudge("classified", "gross_diff_usd", "1", "gross_cause = 'psp_claims_declined'"))
check("residual_is_stated", lambda x: Q.residual_is_stated(x.summary.filter("not (recon_scope = 'fees' and recon_status = 'unexplained')")),
      "reporting_month:d psp recon_scope unexplained_rows:i",
      "SELECT DISTINCT reporting_month, psp, recon_scope, 0 AS unexplained_rows FROM rollup WHERE recon_scope = 'fees'")


def _small_bases(x: Derived) -> DataFrame:
    return x.summary.withColumn("base_usd", (F.col("base_usd") * F.lit(CENT)).cast("decimal(18,2)"))


check("base_covers_scope", lambda x: Q.base_covers_scope(_small_bases(x)),
      "reporting_month:d psp recon_scope base_usd:m scope_abs_usd:m",
      "SELECT reporting_month, psp, recon_scope, max(CAST(round(base_usd * 0.01, 2) AS DECIMAL(18,2))) AS base_usd, "
      "sum(abs_usd) AS scope_abs_usd FROM summary GROUP BY ALL "
      "HAVING sum(abs_usd) > max(CAST(round(base_usd * 0.01, 2) AS DECIMAL(18,2))) + 0.005")
check("subtotals_close", lambda x: Q.subtotals_close(nudged(x.waterfall, "usd", "1", "line_seq = 3 and psp = 'dlocal'")),
      "reporting_month:d psp backend_booked:m backend_fx_faults:m backend_restated:m net_receipts:m",
      "SELECT reporting_month, psp, backend_booked, backend_fx_faults, backend_booked + backend_fx_faults + 1 AS backend_restated, "
      "provider_gross - provider_fees AS net_receipts FROM levels WHERE psp = 'dlocal'")
check("waterfall_ties_to_source",
      lambda x: Q.waterfall_ties_to_source(nudged(x.waterfall, "usd", "1", "line_seq = 5 and psp = 'adyen'"), x.classified),
      "reporting_month:d psp booked_usd:m control_booked_usd:m gross_usd:m control_gross_usd:m net_usd:m control_net_usd:m",
      """SELECT reporting_month, psp, sum(engine_amount_usd_booked_period) AS booked_usd, booked_usd AS control_booked_usd,
           sum(psp_amount_usd_period + psp_amount_usd_duplicate_period) + 1 AS gross_usd, gross_usd - 1 AS control_gross_usd,
           gross_usd - 1 - sum(if(psp_in_period, coalesce(psp_fee_usd, 0), 0)) AS net_usd, net_usd AS control_net_usd
         FROM classified WHERE in_period AND psp = 'adyen' GROUP BY ALL""")

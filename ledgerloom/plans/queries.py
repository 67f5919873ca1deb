"""Registered queries: a Spark plan over the given tables and, where plain SQL can say it, the SQL that
must give the same rows. One column list serves both, so names and types agree."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import PROVIDERS
from ledgerloom.functions import money, text, time
from ledgerloom.operators import classify, matching, pricing, profiling, refdata, report, staging
from ledgerloom.operators.asof import asof_daily
from ledgerloom.plans import oracle, roundtrip
from ledgerloom.plans.derived import EXPORT_DAYS, Derived
from ledgerloom.plans.oracle import with_ctes

# How a column is shown: kind -> (Spark casts, SQL casts), applied in turn. Money and rates are spelt out to the sixth
# place, dates and times by their own type first, so neither side can differ in type or lose a digit.
_SHOWN = {"s": (("string",), ("VARCHAR",)), "m": (("decimal(38,6)", "string"), ("DECIMAL(38,6)", "VARCHAR")),
          "d": (("date", "string"), ("DATE", "VARCHAR")), "t": (("timestamp_ntz", "string"), ("TIMESTAMP", "VARCHAR")),
          "i": (("bigint",), ("BIGINT",)), "b": (("boolean",), ("BOOLEAN",))}


def _cast(column: Column, types: tuple[str, ...]) -> Column:
    return reduce(Column.cast, types, column)


@dataclass(frozen=True)
class Query:
    build: Callable[[Derived], DataFrame]
    columns: str  # "name:kind name:kind ..."; the kind defaults to s
    check: str | None

    def _fields(self) -> list[tuple[str, str]]:
        return [(c.split(":") + ["s"])[:2] for c in self.columns.split()]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(Derived(spark, sf_dir))
        return df.select(*[_cast(F.col(n), _SHOWN[k][0]).alias(n) for n, k in self._fields()])

    def sql(self) -> str | None:
        if self.check is None:
            return None
        shown = ", ".join(
            reduce(lambda cast, kind: f"CAST({cast} AS {kind})", _SHOWN[k][1], n) + f" AS {n}" for n, k in self._fields())
        return f"SELECT {shown} FROM ({self.check})"


QUERIES: dict[str, Query] = {}


def register(name: str, build: Callable[[Derived], DataFrame], columns: str, check: str | None,
             **replaced: str) -> None:
    QUERIES[name] = Query(build, columns, with_ctes(check, **replaced) if check else None)


ROW_KEY = "psp match_key operation_type"
TXN = "txn_id currency"
PERIOD_ROW = f"reporting_month:d {ROW_KEY}"

# --- reference data -------------------------------------------------------------------------------

register("rate_versions", lambda x: x.rate_versions,
         "rate_date:d currency usd_rate:m published_at:t rate_version:i is_current_rate:b",
         "SELECT * FROM rate_versions")
register("current_rate_only", lambda x: refdata.current_rates(x.rate_versions),
         "rate_date:d currency usd_rate:m", "SELECT * FROM current_rates")
register("dim_lookup_rate", lambda x: pricing.published_rate(x.ledger, x.calendar, x.config),
         f"{TXN} fx_date_applied:d fx_rate_published:m",
         "SELECT l.*, if(l.currency = 'USD', 1, r.usd_rate) AS fx_rate_published FROM ledger l "
         "LEFT JOIN current_rates r ON r.rate_date = l.fx_date_applied AND r.currency = l.currency")
register("asof_rate_lateral", lambda x: pricing.expected_rate(x.ledger, x.calendar, x.config),
         f"{TXN} created_at_utc:t fx_date_expected:d fx_rate_expected:m", "SELECT * FROM restated")
register("asof_rate_scalar", lambda x: x.priced, f"{ROW_KEY} psp_reference created_at_utc:t fx_rate_recon:m",
         "SELECT * FROM priced")
register("asof_pricing", lambda x: x.priced,
         f"{ROW_KEY} amount_usd:m amount_usd_settled:m amount_usd_duplicate:m fee_usd:m recognised_at_utc:t",
         "SELECT * FROM priced")
register("asof_null_day",
         lambda x: asof_daily(
             x.payments.withColumn("day", F.when(F.col("k") % 7 != 0, time.day_of(F.col("created_at")))), x.calendar,
             {"currency": "currency"}, F.col("day"), {"usd_rate": "rate"}, x.config),
         "k:i currency day:d rate:m",
         "SELECT k, currency, asof_day AS day, p_rate AS rate FROM ("
         + oracle.asof("payments", "p", "CASE WHEN k % 7 <> 0 THEN CAST(created_at AS DATE) END") + ")")
register("effective_dated_contract", lambda x: x.providers,
         f"{ROW_KEY} psp_account percent_fee:m fixed_fee:m fixed_fee_currency", "SELECT * FROM providers")
register("contracted_fee", lambda x: x.providers, f"{ROW_KEY} fee_local_contracted:m fee_usd_contracted:m",
         "SELECT * FROM providers")
register("fx_fault_class", lambda x: x.restated, f"{TXN} fx_variance_reason", "SELECT * FROM restated")
register("fx_restatement", lambda x: x.restated,
         f"{TXN} amount_usd_engine:m amount_usd_recon:m fx_correction_usd:m", "SELECT * FROM restated")

# --- ingest ---------------------------------------------------------------------------------------

_CONFORMED = ("psp psp_account psp_reference order_ref match_key operation_type status currency amount_local:m "
              "amount_local_settled:m amount_local_authorised:m amount_local_duplicate:m fee_commission_local:m "
              "fee_markup_local:m fee_local:m fee_usd_native:m net_local:m created_at_utc:t settled_at_utc:t")
_RAW_ADYEN = ('SELECT "Merchant Reference" AS order_ref, "Record Type" AS record_type, "Creation Date" AS created, '
              '"Gross Credit" AS credit, "Commission" AS commission FROM adyen_raw')

register("delimited_scan", roundtrip.adyen_file, "order_ref record_type created credit commission", _RAW_ADYEN)
register("alternate_delimiter", roundtrip.paypal_eu_file, "psp_reference day gross fee",
         'SELECT "Transaction ID" AS psp_reference, "Date" AS day, "Gross" AS gross, "Fee" AS fee '
         "FROM paypal_raw WHERE account = 'paypal_eu'")
register("preamble_skip", roundtrip.google_file, "day clock entry sku amount",
         'SELECT "Transaction Date" AS day, "Transaction Time" AS clock, "Transaction Type" AS entry, '
         '"Product ID" AS sku, "Amount (Buyer Currency)" AS amount FROM google_play_raw')
register("quoted_records", roundtrip.quoted_file, "order_id note status", roundtrip.QUOTED_CHECK)
register("multi_file_ledger", roundtrip.google_parts, _CONFORMED, "SELECT * FROM google_play")
register("multi_account_tag", roundtrip.paypal_accounts, f"{_CONFORMED} related_psp_reference date_format_overridden:b",
         "SELECT * FROM paypal")
register("source_registry", roundtrip.registered_views, "source n_rows:i column_name filled:i bytes:i least most",
         roundtrip.REGISTERED_CHECK)
register("byte_normalise", roundtrip.normalised_names, "source line",
         roundtrip.NORMALISED_CHECK)
register("ingest_manifest", roundtrip.manifest_by_file,
         "source file declared encoding_used nfc_changed:b crlf_stripped:i lines:i bytes_out:i sha256_out stored:b sha256_in",
         roundtrip.MANIFEST_CHECK)
register("input_gate", roundtrip.gate, "source fault n_lines:i", roundtrip.GATE_CHECK)
register("table_store", roundtrip.stored_summary, "reporting_month:d psp recon_scope recon_cause abs_usd:m",
         "SELECT * FROM summary")
register("ordered_csv_export", roundtrip.exported_waterfall, "reporting_month psp line_seq:i line_item usd:m",
         "SELECT reporting_month, psp, line_seq, line_item, usd FROM waterfall")

# --- staging --------------------------------------------------------------------------------------

register("typed_ledger", lambda x: x.ledger,
         "txn_id order_id operation_type status psp psp_reference sku country currency amount_local:m "
         "fx_rate_applied:m fx_date_applied:d amount_usd:m created_at_utc:t captured_at_utc:t", "SELECT * FROM ledger")
register("renamed_events", lambda x: staging.adyen_events(x.adyen_raw),
         "psp_account psp_reference order_ref record_type currency gross_credit:m net_debit:m",
         'SELECT "Merchant Account" AS psp_account, "Psp Reference" AS psp_reference, "Merchant Reference" AS order_ref, '
         '"Record Type" AS record_type, "Gross Currency" AS currency, "Gross Credit" AS gross_credit, '
         '"Net Debit" AS net_debit FROM adyen_raw')
register("lifecycle_fold", lambda x: x.adyen, _CONFORMED, "SELECT * FROM adyen")
register("fee_row_fold", lambda x: x.google_play, _CONFORMED, "SELECT * FROM google_play")
register("conformed_padding", lambda x: x.dlocal, _CONFORMED, "SELECT * FROM dlocal")
register("split_fee_sum", lambda x: x.adyen.filter("status = 'settled'"),
         "psp_reference operation_type fee_commission_local:m fee_markup_local:m fee_local:m",
         "SELECT * FROM adyen WHERE status = 'settled'")
register("conform_union", lambda x: x.conformed, _CONFORMED, "SELECT * FROM conformed")
register("exact_dedup", lambda x: x.dlocal_raw.dropDuplicates(), "transaction_id transaction_type status local_amount fee_usd",
         "SELECT DISTINCT * FROM dlocal_raw")
register("dedup_with_surplus", lambda x: x.dlocal.unionByName(x.paypal.select(*x.dlocal.columns)),
         "psp psp_reference operation_type amount_local:m amount_local_duplicate:m",
         "SELECT psp, psp_reference, operation_type, amount_local, amount_local_duplicate FROM dlocal "
         "UNION ALL SELECT psp, psp_reference, operation_type, amount_local, amount_local_duplicate FROM paypal")
register("status_vocabulary",
         lambda x: x.conformed.groupBy("psp", "operation_type", "status").agg(F.count("*").alias("n_rows")),
         "psp operation_type status n_rows:i",
         "SELECT psp, operation_type, status, count(*) AS n_rows FROM conformed GROUP BY ALL")
register("dual_date_resolution", lambda x: staging.paypal_typed(x.paypal_raw, *x.window),
         "psp_reference event_at:t date_format_overridden:b date_unresolved:b",
         "SELECT psp_reference, created_at_utc AS event_at, date_format_overridden, date_unresolved FROM paypal")
register("decimal_comma_parse",
         lambda x: x.paypal_raw.select(
             "account", F.col("`Transaction ID`").alias("psp_reference"), F.col("Gross").alias("written"),
             text.money(F.col("Gross")).alias("gross"), text.money(F.col("Net")).alias("net")),
         "account psp_reference written gross:m net:m",
         """SELECT account, "Transaction ID" AS psp_reference, "Gross" AS written,
            CAST(replace("Gross", ',', '.') AS DECIMAL(18,2)) AS gross,
            CAST(replace("Net", ',', '.') AS DECIMAL(18,2)) AS net FROM paypal_raw""")
register("minor_unit_scale", lambda x: staging.dlocal_typed(x.dlocal_raw),
         "psp_reference transaction_type currency amount:m n_copies:i",
         """SELECT transaction_id AS psp_reference, transaction_type, currency, CAST(local_amount AS DECIMAL(18,2))
            * if(currency = 'CLP', 1.00, 0.01) AS amount, count(*) AS n_copies FROM dlocal_raw
            GROUP BY transaction_id, transaction_type, currency, local_amount""")
register("local_to_utc",
         lambda x: staging.adyen_events(x.adyen_raw).select("order_ref", "record_type", "event_at")
         .unionByName(staging.google_play_entries(x.google_play_raw).select(
             F.col("sku").alias("order_ref"), F.col("entry").alias("record_type"), "event_at")),
         "order_ref record_type event_at:t",
         """SELECT "Merchant Reference" AS order_ref, "Record Type" AS record_type,
              timezone('UTC', timezone('Europe/Amsterdam', CAST("Creation Date" AS TIMESTAMP))) AS event_at FROM adyen_raw
            UNION ALL SELECT "Product ID", "Transaction Type", timezone('UTC', timezone('America/Los_Angeles',
              strptime("Transaction Date" || ' ' || "Transaction Time", '%b %-d, %Y %H:%M:%S'))) FROM google_play_raw""")
register("composite_match_key",
         lambda x: x.ledger.select("txn_id", "psp", matching.ledger_match_key().alias("match_key")),
         "txn_id psp match_key", "SELECT * FROM signed")

# --- filters --------------------------------------------------------------------------------------

register("filter_events_by_type",
         lambda x: staging.adyen_events(x.adyen_raw).filter(F.col("record_type").isin("Refunded", "Chargeback")),
         "order_ref record_type gross_debit:m",
         'SELECT "Merchant Reference" AS order_ref, "Record Type" AS record_type, "Gross Debit" AS gross_debit '
         "FROM adyen_raw WHERE \"Record Type\" IN ('Refunded', 'Chargeback')")
register("filter_export_window",
         lambda x: x.paypal_raw.withColumn(
             "day", time.day_of(time.clock_time(
             time.clock_parts(F.col("Date"), F.col("Time")), "dmy")))
         .filter("account = 'paypal_eu'").filter(~F.col("day").between(*x.window))
         .select(F.col("`Transaction ID`").alias("psp_reference"), "day"),
         "psp_reference day:d",
         f"""SELECT "Transaction ID" AS psp_reference, CAST(try_strptime("Date", '%d/%m/%Y') AS DATE) AS day FROM paypal_raw
             WHERE account = 'paypal_eu' AND CAST(try_strptime("Date", '%d/%m/%Y') AS DATE)
               NOT BETWEEN CAST(export_month AS DATE) AND CAST(export_month AS DATE) + {EXPORT_DAYS}""")
register("filter_period_shift", lambda x: x.matched.filter(~F.col("engine_period").eqNullSafe(F.col("psp_period"))),
         f"{ROW_KEY} engine_period:d psp_period:d",
         "SELECT * FROM matched WHERE engine_period IS DISTINCT FROM psp_period")
register("filter_one_sided", lambda x: x.matched.filter("not in_engine or not in_psp"),
         f"{ROW_KEY} in_engine:b in_psp:b diff_usd:m",
         "SELECT * FROM matched WHERE txn_id IS NULL OR psp_status IS NULL")

# --- match and classification ---------------------------------------------------------------------

register("scope_semi_join", lambda x: matching.only_reported(x.ledger, x.adyen.unionByName(x.dlocal)),
         "txn_id psp", "SELECT * FROM ledger WHERE psp IN (SELECT psp FROM adyen UNION SELECT psp FROM dlocal)")
register("signed_settled", lambda x: x.signed,
         "txn_id operation_type status amount_local:m amount_local_settled:m amount_usd_settled:m amount_usd_booked:m",
         "SELECT * FROM signed")
register("recognition_period", lambda x: x.matched,
         f"{ROW_KEY} engine_recognised_at_utc:t psp_recognised_at_utc:t engine_period:d psp_period:d",
         "SELECT * FROM matched")
register("two_sided_match", lambda x: x.matched,
         f"{ROW_KEY} order_ref txn_id psp_reference in_engine:b in_psp:b engine_status psp_status diff_local:m diff_usd:m",
         "SELECT * FROM matched")
register("period_scoping", lambda x: x.scoped,
         f"{PERIOD_ROW} engine_in_period:b psp_in_period:b in_period:b engine_amount_usd_period:m "
         "engine_amount_usd_booked_period:m psp_amount_usd_period:m psp_amount_usd_duplicate_period:m",
         "SELECT * FROM scoped")
register("scope_diffs", lambda x: x.classified,
         f"{PERIOD_ROW} gross_diff_usd:m bug_diff_usd:m net_diff_usd:m", "SELECT * FROM classified")
register("bug_cause", lambda x: x.classified, f"{PERIOD_ROW} bug_cause", "SELECT * FROM classified")
register("fee_cause", lambda x: x.classified, f"{PERIOD_ROW} net_cause", "SELECT * FROM classified")
register("gross_cause", lambda x: x.classified, f"{PERIOD_ROW} gross_cause", "SELECT * FROM classified")
register("status_rollup", lambda x: x.classified, f"{PERIOD_ROW} bug_status net_status gross_status in_period:b",
         "SELECT * FROM classified")

# --- report ---------------------------------------------------------------------------------------

SCOPE_ROW = "reporting_month:d psp recon_scope"
LINE_ROW = f"{SCOPE_ROW} recon_status recon_cause"

register("scope_unpivot", lambda x: report.scope_lines(x.classified), f"{LINE_ROW} diff_usd:m", "SELECT * FROM lines")
register("materiality_bases", lambda x: report.materiality_bases(x.classified), f"{SCOPE_ROW} base_label base_usd:m",
         "SELECT * FROM bases")
register("cause_rollup", lambda x: report.cause_rollup(report.scope_lines(x.classified)),
         f"{LINE_ROW} n_rows:i abs_usd:m signed_usd:m", "SELECT * FROM rollup")
register("stated_residual", lambda x: report.stated_residual(report.cause_rollup(report.scope_lines(x.classified))),
         f"{LINE_ROW} n_rows:i abs_usd:m", "SELECT * FROM residual")
register("materiality_shares",
         lambda x: x.summary, f"{LINE_ROW} pct_of_base:m pct_of_scope_discrepancy:m pct_of_total_discrepancy:m",
         "SELECT * FROM summary")
register("recon_summary", lambda x: x.summary,
         f"{LINE_ROW} n_rows:i abs_usd:m signed_usd:m base_label base_usd:m pct_of_base:m "
         "pct_of_scope_discrepancy:m pct_of_total_discrepancy:m", "SELECT * FROM summary")
register("filtered_agg_levels", lambda x: report.waterfall_levels(x.summary),
         "reporting_month:d psp backend_booked:m backend_fx_faults:m provider_variance:m provider_gross:m provider_fees:m",
         "SELECT * FROM levels")
register("recon_waterfall", lambda x: x.waterfall,
         "reporting_month:d psp line_seq:i line_item usd:m is_subtotal:b", "SELECT * FROM waterfall")
register("waterfall_lines", lambda x: x.waterfall.filter("is_subtotal"),
         "reporting_month:d psp line_seq:i line_item usd:m", "SELECT * FROM waterfall WHERE is_subtotal")
_CELLS = ", ".join(f"coalesce(sum(usd) FILTER (psp = '{p}'), 0) AS {p}" for p in PROVIDERS)
register("waterfall_pivot_total", lambda x: report.waterfall_pivot_total(x.waterfall),
         "reporting_month:d line_seq:i line_item is_subtotal:b " + " ".join(f"{p}:m" for p in PROVIDERS) + " total:m",
         f"SELECT reporting_month, line_seq, line_item, is_subtotal, {_CELLS}, sum(usd) AS total FROM waterfall GROUP BY ALL")
_FURTHER = ("(SELECT * FROM waterfall UNION ALL SELECT * REPLACE ('zeta_pay' AS psp) FROM waterfall WHERE psp = 'adyen')")
_SIX = (*PROVIDERS, "zeta_pay")
register("waterfall_further_provider",
         lambda x: report.waterfall_pivot_total(x.waterfall.unionByName(
             x.waterfall.filter("psp = 'adyen'").withColumn("psp", F.lit("zeta_pay")))),
         "reporting_month:d line_seq:i line_item " + " ".join(f"{p}:m" for p in _SIX) + " total:m",
         "SELECT reporting_month, line_seq, line_item, "
         + ", ".join(f"coalesce(sum(usd) FILTER (psp = '{p}'), 0) AS {p}" for p in _SIX)
         + f", sum(usd) AS total FROM {_FURTHER} GROUP BY ALL")

# --- money without a date: its own period, so that no row is lost from a run over all periods ------------

_DATELESS = {"engine_period": "%7", "psp_period": "%3"}


def _undated(x: Derived) -> DataFrame:
    return x.matched.withColumns({
        name: F.when(~(F.col("match_key").like(ending) | F.col("match_key").like("%5")), F.col(name))
        for name, ending in _DATELESS.items()})


register("undated_period", lambda x: report.recon_summary(classify.classify(classify.scope_to_period(_undated(x)))),
         f"{LINE_ROW} n_rows:i abs_usd:m signed_usd:m base_label base_usd:m pct_of_base:m "
         "pct_of_scope_discrepancy:m pct_of_total_discrepancy:m", "SELECT * FROM summary",
         matched="SELECT * REPLACE (" + ", ".join(
             f"CASE WHEN NOT (match_key LIKE '{ending}' OR match_key LIKE '%5') THEN {name} END AS {name}"
             for name, ending in _DATELESS.items()) + f") FROM ({oracle.CTES['matched']})")

# --- the whole run over written files, for one month ------------------------------------------------

_MONTH_ONLY = {
    "paypal_raw": f"SELECT * FROM paypal_raw_as_is WHERE export_month = '{roundtrip.MONTH}'",
    "matched": oracle.CTES["matched"].replace("date_trunc('year'", "date_trunc('month'")}
register("run_month_summary", lambda x: roundtrip.month_run(x).tables["summary"],
         f"{LINE_ROW} n_rows:i abs_usd:m signed_usd:m base_label base_usd:m pct_of_base:m "
         "pct_of_scope_discrepancy:m pct_of_total_discrepancy:m",
         f"SELECT * FROM summary WHERE reporting_month = DATE '{roundtrip.MONTH}'", **_MONTH_ONLY)
register("run_month_waterfall", lambda x: roundtrip.month_run(x).tables["waterfall"],
         "reporting_month:d psp line_seq:i line_item usd:m is_subtotal:b",
         f"SELECT * FROM waterfall WHERE reporting_month = DATE '{roundtrip.MONTH}'", **_MONTH_ONLY)


def _cell(amount: str) -> str:
    shown = f"format('{{:,.2f}}', CAST(abs({amount}) AS DOUBLE))"
    return f"CASE WHEN {amount} = 0 THEN '—' WHEN {amount} < 0 THEN '(' || {shown} || ')' ELSE {shown} END"


def _bold(cell: str) -> str:
    return f"CASE WHEN is_subtotal AND {cell} <> '—' THEN '**' || {cell} || '**' ELSE {cell} END"


register("waterfall_rendered", lambda x: report.rendered_waterfall(report.waterfall_pivot_total(x.waterfall)),
         "reporting_month:d line_seq:i line " + " ".join(PROVIDERS) + " total",
         "SELECT reporting_month, line_seq, if(is_subtotal, '**' || l || '**', l) AS line, "
         + ", ".join(f"{_bold(_cell(p))} AS {p}" for p in PROVIDERS) + f", '**' || {_cell('total')} || '**' AS total FROM ("
         f"SELECT reporting_month, line_seq, is_subtotal, upper(line_item[1]) || replace(replace(line_item[2:], '_', ' '), ' fx ', ' FX ') AS l, "
         f"{_CELLS}, sum(usd) AS total FROM waterfall GROUP BY ALL)")
_BUCKETS = ", ".join(
    f"coalesce(sum(diff_usd) FILTER (recon_status = '{s}'), 0) AS {s}_usd" for s in ("matched", "explained", "unexplained"))
register("bucket_control_totals",
         lambda x: report.scope_lines(x.classified).groupBy("reporting_month", "psp", "recon_scope").agg(*[
             F.coalesce(F.sum(F.when(F.col("recon_status") == s, F.col("diff_usd"))), money.zero()).alias(f"{s}_usd")
             for s in ("matched", "explained", "unexplained")]),
         f"{SCOPE_ROW} matched_usd:m explained_usd:m unexplained_usd:m",
         f"SELECT reporting_month, psp, recon_scope, {_BUCKETS} FROM lines GROUP BY ALL")

# --- profiles -------------------------------------------------------------------------------------

register("profile_key_uniqueness",
         lambda x: profiling.key_uniqueness(x.table("lineitem"), ["l_orderkey", "l_linenumber"]),
         "n_rows:i n_keys:i most_rows_per_key:i",
         "SELECT sum(n) AS n_rows, count(*) AS n_keys, max(n) AS most_rows_per_key FROM "
         "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
for _export in ("payment_log_raw", "paypal_raw", "adyen_raw", "dlocal_raw", "google_play_raw", "fx_rates_raw"):
    register(f"profile_columns_{_export.removesuffix('_raw')}",
             lambda x, export=_export: profiling.column_profile(getattr(x, export)),
             "column_name n_rows:i n_null:i n_blank:i shortest:i longest:i smallest largest",
             "SELECT column_name, count(*) AS n_rows, count(*) FILTER (v IS NULL) AS n_null, "
             "count(*) FILTER (trim(v) = '') AS n_blank, min(length(v)) AS shortest, max(length(v)) AS longest, "
             "min(v) AS smallest, max(v) AS largest FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM "
             f"{_export}) UNPIVOT INCLUDE NULLS (v FOR column_name IN (COLUMNS(*))) GROUP BY column_name")
register("profile_lifecycle_sets",
         lambda x: profiling.lifecycle_sets(staging.adyen_events(x.adyen_raw), "order_ref", "record_type"),
         "states n_keys:i",
         "SELECT states, count(*) AS n_keys FROM (SELECT \"Merchant Reference\" AS r, "
         "array_to_string(list_sort(list(DISTINCT \"Record Type\")), '+') AS states FROM adyen_raw GROUP BY 1) GROUP BY 1")
register("profile_event_sets", lambda x: profiling.lifecycle_sets(x.table("events"), "user_id", "event_type"),
         "states n_keys:i",
         "SELECT states, count(*) AS n_keys FROM (SELECT user_id, "
         "array_to_string(list_sort(list(DISTINCT event_type)), '+') AS states FROM events GROUP BY 1) GROUP BY 1")
register("profile_vocab_crosstab", lambda x: profiling.vocabulary_crosstab(x.ledger, ["psp", "status", "operation_type"]),
         "psp status operation_type n_rows:i",
         "SELECT psp, status, operation_type, count(*) AS n_rows FROM ledger GROUP BY ALL")
register("profile_decline_rates",
         lambda x: profiling.rates_by(x.ledger, "psp", declined=F.col("status") == "declined",
                                      reversed=F.col("operation_type") != "sale"),
         "psp n_rows:i n_declined:i declined_bp:i n_reversed:i reversed_bp:i",
         "SELECT psp, n AS n_rows, d AS n_declined, (d * 20000 + n) // (n * 2) AS declined_bp, r AS n_reversed, "
         "(r * 20000 + n) // (n * 2) AS reversed_bp FROM (SELECT psp, count(*) AS n, count(*) FILTER (status = 'declined') AS d, "
         "count(*) FILTER (operation_type <> 'sale') AS r FROM ledger GROUP BY psp)")
register("profile_sequence_gaps",
         lambda x: profiling.sequence_gaps(
             x.ledger.filter("txn_id like 'T-%'").select(F.split_part("txn_id", F.lit("-"), F.lit(2)).alias("n")), "n", 1000),
         "first_missing:i last_missing:i n_missing:i",
         "SELECT p + 1 AS first_missing, n - 1 AS last_missing, n - p - 1 AS n_missing FROM (SELECT n, lag(n) OVER (ORDER BY n) AS p "
         "FROM (SELECT DISTINCT CAST(split_part(txn_id, '-', 2) AS BIGINT) AS n FROM ledger WHERE txn_id LIKE 'T-%')) WHERE n - p > 1")
register("profile_calendar_holes", lambda x: profiling.calendar_holes(x.fx_rates_raw, "rate_date", "currency"),
         "currency day:d",
         "SELECT s.currency, s.day FROM (SELECT currency, CAST(unnest(generate_series(min(CAST(rate_date AS DATE)), "
         "max(CAST(rate_date AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM fx_rates_raw GROUP BY currency) s "
         "WHERE dayofweek(s.day) NOT IN (0, 6) AND NOT EXISTS (SELECT 1 FROM fx_rates_raw f WHERE f.currency = s.currency "
         "AND CAST(f.rate_date AS DATE) = s.day)")
register("profile_range", lambda x: profiling.value_range(x.rate_versions, "currency", "usd_rate"),
         "currency n_rows:i low:m high:m spread_bp:i",
         "SELECT currency, count(*) AS n_rows, min(usd_rate) AS low, max(usd_rate) AS high, "
         "((CAST(max(usd_rate) * 1000000 AS BIGINT) - CAST(min(usd_rate) * 1000000 AS BIGINT)) * 10000) "
         "// CAST(min(usd_rate) * 1000000 AS BIGINT) AS spread_bp FROM rate_versions GROUP BY currency")
register("profile_coverage",
         lambda x: profiling.coverage(x.signed, x.conformed, matching.MATCH_KEYS), "in_both:i left_only:i right_only:i",
         "SELECT count(*) FILTER (a AND b) AS in_both, count(*) FILTER (NOT b) AS left_only, count(*) FILTER (NOT a) AS right_only "
         "FROM (SELECT psp, match_key, operation_type, bool_or(e) AS a, bool_or(NOT e) AS b FROM "
         "(SELECT psp, match_key, operation_type, true AS e FROM signed UNION ALL "
         "SELECT psp, match_key, operation_type, false FROM conformed) WHERE match_key IS NOT NULL GROUP BY ALL)")

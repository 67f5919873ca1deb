"""One row per branch of the cause chains, then the identities the report must keep."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.config import MONEY, RunConfig
from ledgerloom.operators import classify, matching, pricing, quality, refdata, report

JUNE, JULY = datetime(2026, 6, 10, 12), datetime(2026, 7, 2, 12)
MONTH = date(2026, 6, 1)

LEDGER = T.StructType(
    [T.StructField(c, T.StringType()) for c in (
        "txn_id", "order_id", "operation_type", "status", "psp", "psp_reference", "sku", "country", "currency")]
    + [T.StructField("amount_local", MONEY), T.StructField("fx_rate_applied", T.DecimalType(18, 6)),
       T.StructField("fx_date_applied", T.DateType()), T.StructField("amount_usd", MONEY),
       T.StructField("created_at_utc", T.TimestampNTZType()), T.StructField("captured_at_utc", T.TimestampNTZType())])


def ledger_row(order, status="settled", amount="10.00", currency="USD", rate="1", usd=None, day=date(2026, 6, 10),
               created=JUNE, captured=JUNE, operation="sale", psp="adyen"):
    usd = usd or str(round(D(amount) * D(rate), 2))
    return (f"T-{order}-{operation}", order, operation, status, psp, f"X{order}", "sub", "DE", currency, D(amount), D(rate), day,
            D(usd), created, captured if status == "settled" else None)


@pytest.fixture(scope="module")
def rates(spark):
    raw = [("2026-06-05", "EUR", "1.050000", "2026-06-05T16:00:00Z"), ("2026-06-08", "EUR", "1.080000", "2026-06-08T16:00:00Z"),
           ("2026-06-10", "EUR", "1.090000", "2026-06-10T16:00:00Z"), ("2026-06-10", "EUR", "1.100000", "2026-06-12T16:00:00Z")]
    versions = refdata.rate_versions(spark.createDataFrame(raw, "rate_date string, currency string, usd_rate string, published_at string"))
    return refdata.rate_calendar(refdata.current_rates(versions))


FX = [  # order, ledger row, reason, restated usd
    ("usd", ledger_row("usd"), "none", "10.00"),
    ("ok", ledger_row("ok", currency="EUR", rate="1.1"), "none", "11.00"),
    ("weekend", ledger_row("weekend", currency="EUR", rate="1.05", day=date(2026, 6, 5), created=datetime(2026, 6, 7)), "none", "10.50"),
    ("unpublished", ledger_row("unpublished", currency="EUR", rate="1.1", day=date(2026, 6, 9)), "fx_rate_unpublished", "11.00"),
    ("skipped", ledger_row("skipped", currency="EUR", rate="1"), "fx_not_applied", "11.00"),
    ("superseded", ledger_row("superseded", currency="EUR", rate="1.09"), "fx_rate_mismatch", "11.00"),
    ("stale", ledger_row("stale", currency="EUR", rate="1.08", day=date(2026, 6, 8)), "fx_date_stale", "11.00"),
    ("early", ledger_row("early", currency="EUR", rate="1.2", usd="12.00", created=datetime(2026, 6, 1)), "fx_rate_mismatch", "12.00")]


def test_fx_faults_and_restatement(spark, rates):
    df = pricing.restate_ledger(spark.createDataFrame([row for _, row, _, _ in FX], LEDGER), rates)
    got = {r.order_id: (r.fx_variance_reason, str(r.amount_usd_recon)) for r in df.collect()}
    assert got == {order: (reason, usd) for order, _, reason, usd in FX}
    booked = {r.order_id: (r.amount_usd_engine, r.fx_correction_usd) for r in df.collect()}
    assert booked["skipped"] == (D("10.00"), D("-1.00"))  # the booked value stays
    assert quality.fx_correction_arithmetic(df).count() == 0


MATCH = dict(
    psp="adyen", match_key="k", operation_type="sale", order_ref="o", in_engine=True, in_psp=True,
    engine_status="settled", psp_status="settled", engine_currency="USD", psp_currency="USD",
    engine_amount_local_settled="10.00", psp_amount_local_settled="10.00", psp_amount_local_authorised=None,
    engine_amount_usd_settled="10.00", engine_amount_usd_booked="10.00", psp_amount_usd_settled="10.00",
    psp_amount_usd_duplicate=None, psp_fee_local="1.00", psp_fee_usd="1.00", fee_local_contracted="1.00",
    fee_usd_contracted="1.00", engine_fx_variance_reason="none", fixed_fee="0.00", fixed_fee_currency=None,
    engine_period=MONTH, psp_period=MONTH, diff_local="0.00", diff_usd="0.00")
TYPES = {c: ("decimal(18,2)" if any(p in c for p in ("amount", "fee", "diff")) and c != "fixed_fee_currency" else
             "boolean" if c.startswith("in_") else "date" if c.endswith("period") else "string") for c in MATCH}


def matched(spark, *changes):
    rows = []
    for i, change in enumerate(changes):
        row = {**MATCH, "match_key": f"k{i}", **change}
        rows.append(tuple(D(v) if TYPES[c].startswith("dec") and v is not None else v for c, v in row.items()))
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in TYPES.items()))


ENGINE_ONLY = dict(in_psp=False, psp_status=None, psp_currency=None, psp_amount_local_settled=None, psp_amount_usd_settled=None,
                   psp_fee_local=None, psp_fee_usd=None, fee_local_contracted=None, fee_usd_contracted=None, psp_period=None)
PSP_ONLY = dict(in_engine=False, engine_status=None, engine_currency=None, engine_amount_local_settled=None,
                engine_amount_usd_settled=None, engine_amount_usd_booked=None, engine_fx_variance_reason=None, engine_period=None)
ZERO_PSP = dict(psp_amount_local_settled="0.00", psp_amount_usd_settled="0.00")
GROSS = [
    (dict(), "matched", "0.00"),
    (PSP_ONLY, "psp_claims_sale", "10.00"),
    ({**PSP_ONLY, "operation_type": "refund", "psp_amount_usd_settled": "-4.00"}, "psp_claims_refund", "-4.00"),
    ({**PSP_ONLY, "operation_type": "chargeback", "psp_amount_usd_settled": "-4.00"}, "psp_claims_chargeback", "-4.00"),
    (ENGINE_ONLY, "engine_claims_sale", "-10.00"),
    ({**ENGINE_ONLY, "operation_type": "refund"}, "engine_claims_refund", "-10.00"),
    ({**ZERO_PSP, "psp_status": "declined"}, "psp_claims_declined", "-10.00"),
    ({**ZERO_PSP, "psp_status": "disputed"}, "psp_claims_disputed", "-10.00"),
    (dict(engine_status="pending", engine_amount_local_settled="0.00", engine_amount_usd_settled="0.00",
          engine_amount_usd_booked="0.00", engine_period=date(2026, 5, 1)), "engine_capture_not_recorded", "10.00"),
    (dict(psp_amount_local_settled="6.00", psp_amount_usd_settled="6.00", psp_amount_local_authorised="10.00"),
     "psp_claims_partial_capture", "-4.00"),
    (dict(psp_period=date(2026, 7, 1)), "psp_claims_captured_different_period", "-10.00"),
    (dict(psp_amount_usd_duplicate="10.00"), "psp_claims_duplicate_row", "10.00"),
    (dict(psp_amount_usd_settled="10.01"), "psp_fx_date_basis", "0.01"),
    (dict(psp_amount_local_settled="12.00", psp_amount_usd_settled="12.00"), "psp_claims_different_amount", "2.00"),
    (dict(psp_currency="EUR", psp_amount_usd_settled="12.00"), "unexplained", "2.00"),
    # an attempt that never settled and that the provider is silent on falls through to the period rule
    ({**ENGINE_ONLY, "engine_status": "declined", "engine_amount_usd_settled": "0.00", "engine_amount_usd_booked": "0.00"},
     "psp_claims_captured_different_period", "0.00")]


def classified(spark, *changes, period=MONTH, **options):
    return classify.classify(classify.scope_to_period(matched(spark, *changes), period), **options)


def test_gross_causes(spark):
    rows = sorted(classified(spark, *[c for c, _, _ in GROSS]).collect(), key=lambda r: int(r.match_key[1:]))
    assert [(r.gross_cause, str(r.gross_diff_usd)) for r in rows] == [(cause, diff) for _, cause, diff in GROSS]
    assert all(r.gross_status == (r.gross_cause if r.gross_cause in ("matched", "unexplained") else "explained") for r in rows)


def test_optional_rule_names_silent_attempts(spark):
    row = classified(spark, GROSS[-1][0], report_silent_attempts=True).first()
    assert row.gross_cause == "engine_attempt_unreported"


FEES = [
    (dict(), "matched", "0.00"),
    (dict(psp_fee_local="1.50", psp_fee_usd="1.50"), "psp_fee_overcharge", "-0.50"),
    (dict(psp_fee_local="0.75", psp_fee_usd="0.75"), "psp_fee_undercharge", "0.25"),
    (dict(fee_local_contracted=None, fee_usd_contracted=None), "psp_claims_fee_out_of_contract", "-1.00"),
    (dict(fee_local_contracted=None, fee_usd_contracted=None, psp_fee_local=None, psp_fee_usd=None), "fee_not_contracted", "0.00"),
    (dict(psp_fee_local=None, psp_fee_usd=None), "psp_fee_missing", "1.00"),
    (dict(operation_type="refund", fee_local_contracted=None, fee_usd_contracted=None), None, "0.00"),
    (dict(psp_status="declined", fee_local_contracted=None, fee_usd_contracted=None), None, "0.00"),
    (ENGINE_ONLY, None, "0.00"),
    (dict(psp_period=date(2026, 7, 1), psp_fee_local="1.50", psp_fee_usd="1.50"), "psp_fee_overcharge", "0.00")]


def test_fee_causes(spark):
    df = classified(spark, *[c for c, _, _ in FEES])
    rows = sorted(df.collect(), key=lambda r: int(r.match_key[1:]))
    assert [(r.net_cause, str(r.net_diff_usd)) for r in rows] == [(cause, diff) for _, cause, diff in FEES]
    assert [r.net_status for r in rows if r.net_cause is None] == [None] * 3
    assert quality.fee_verdict_on_settled_sales(df).count() == 0


def test_bug_causes(spark):
    reasons = ["none", "fx_not_applied", "fx_rate_mismatch", "fx_date_stale", "fx_rate_unpublished"]
    df = classified(spark, *[dict(engine_fx_variance_reason=r) for r in reasons], PSP_ONLY)
    rows = sorted(df.collect(), key=lambda r: int(r.match_key[1:]))
    assert [r.bug_cause for r in rows] == ["matched"] + [f"engine_{r}" for r in reasons[1:]] + [None]
    assert [r.bug_status for r in rows] == ["matched"] + ["explained"] * 4 + [None]


def test_every_period_in_one_pass_equals_one_run_per_period(spark):
    data = [c for c, _, _ in GROSS]
    keys = ["reporting_month", "psp", "recon_scope", "recon_cause", "n_rows", "abs_usd", "signed_usd", "base_usd", "pct_of_base",
            "pct_of_scope_discrepancy", "pct_of_total_discrepancy"]
    together = report.recon_summary(classified(spark, *data, period=None)).select(*keys).collect()
    apart = []
    for month in (date(2026, 5, 1), MONTH, date(2026, 7, 1)):
        apart += report.recon_summary(classified(spark, *data, period=month)).select(*keys).collect()
    assert sorted(map(str, together)) == sorted(map(str, apart)) and len(apart) > 10


def test_out_of_period_rows_are_kept_in_the_layer_and_absent_from_the_report(spark):
    df = classified(spark, {**PSP_ONLY, "psp_period": date(2026, 7, 1)}, dict())
    assert df.count() == 2
    lines = report.scope_lines(df).groupBy("recon_scope").count().collect()
    assert {r.recon_scope: r["count"] for r in lines} == {"backend_fx": 1, "gross": 1, "fees": 1}


def test_report_closes_and_states_its_residual(spark):
    faults = [dict(engine_amount_usd_booked="12.00", engine_fx_variance_reason="fx_rate_mismatch")]
    df = classified(spark, *[c for c, _, _ in GROSS], *[c for c, _, _ in FEES], *faults, period=None)
    summary = report.recon_summary(df)
    waterfall = report.recon_waterfall(summary)
    for check in (quality.buckets_reconcile(df), quality.waterfall_closes(df), quality.residual_is_stated(summary),
                  quality.subtotals_close(waterfall), quality.waterfall_ties_to_source(waterfall, df)):
        assert check.count() == 0
    rollup = report.cause_rollup(report.scope_lines(df))
    stated = {(str(r.reporting_month), r.recon_scope) for r in report.stated_residual(rollup).collect()}
    in_summary = {(str(r.reporting_month), r.recon_scope) for r in summary.filter("recon_cause = 'unexplained' and n_rows = 0").collect()}
    assert stated == in_summary and stated
    june = {r.line_item: r.usd for r in waterfall.filter("reporting_month = '2026-06-01'").collect()}
    assert june["net_receipts"] == june["backend_booked"] + june["backend_fx_faults"] + june["provider_variance"] + june["provider_fees"]


def test_base_counts_rows_without_a_verdict(spark):
    df = classified(spark, dict(), dict(psp_status="declined", fee_local_contracted=None, fee_usd_contracted=None))
    fees = report.recon_summary(df).filter("recon_scope = 'fees'").collect()
    assert {r.recon_cause: (r.n_rows, r.base_usd) for r in fees} == {"matched": (1, D("2.00")), "unexplained": (0, D("2.00"))}
    assert report.materiality_bases(df).filter("recon_scope = 'fees'").first().base_usd == D("2.00")


# --- published identities: the arithmetic of a report known to be right ---

PUBLISHED = {  # booked, faults, variance, gross, fees, net
    "adyen": ("32912.09", "0.03", "-115.98", "32796.14", "829.42", "31966.72"),
    "dlocal": ("215642.53", "-200678.97", "-14.11", "14949.45", "751.25", "14198.20")}


def test_published_waterfall_identities(spark):
    rows = []
    for psp, (booked, faults, variance, gross, fees, _) in PUBLISHED.items():
        rows += [(MONTH, psp, "backend_fx", D(faults), D(booked)), (MONTH, psp, "gross", D(variance), D(gross)),
                 (MONTH, psp, "fees", D("0"), D(fees))]
    summary = spark.createDataFrame(
        rows, "reporting_month date, psp string, recon_scope string, signed_usd decimal(18,2), base_usd decimal(18,2)")
    waterfall = report.recon_waterfall(summary)
    assert quality.subtotals_close(waterfall).count() == 0
    net = {r.psp: r.usd for r in waterfall.filter("line_item = 'net_receipts'").collect()}
    assert net == {psp: D(v[-1]) for psp, v in PUBLISHED.items()}
    pivot = report.waterfall_pivot_total(waterfall, ["adyen", "dlocal", "paypal_us"])
    last = pivot.filter("line_seq = 7").first()
    assert (last.total, last.paypal_us) == (D("46164.92"), D("0.00"))
    shown = {r.line_seq: r for r in report.rendered_waterfall(pivot, ["adyen", "dlocal", "paypal_us"]).collect()}
    assert (shown[2].line, shown[2].dlocal, shown[2].paypal_us) == ("Backend FX faults", "(200,678.97)", "—")
    assert (shown[7].line, shown[7].adyen, shown[7].total) == ("**Net receipts**", "**31,966.72**", "**46,164.92**")


# --- metamorphic ---

def pair(spark, rates, ledger, providers):
    contracts = refdata.contract_spans(refdata.fee_contracts(spark.createDataFrame(
        [("adyen", "EU", "2026-01-01", "2.5", "0.00", "")],
        "psp string, account string, valid_from string, percent_fee string, fixed_fee string, fixed_fee_currency string")))
    ours = matching.signed_ledger(pricing.restate_ledger(spark.createDataFrame(ledger, LEDGER), rates))
    theirs = pricing.apply_contracts(pricing.price_providers(providers, rates), contracts)
    return report.recon_summary(classify.classify(classify.scope_to_period(matching.match_sides(ours, theirs), MONTH)))


def provider_rows(spark, rows):
    from ledgerloom.operators.staging import conform
    df = spark.createDataFrame(rows, "ref string, amount decimal(18,2), dup decimal(18,2)")
    at = F.lit("2026-06-10 12:00:00").cast("timestamp_ntz")
    return conform(df, psp=F.lit("adyen"), psp_account=F.lit("EU"), psp_reference=F.col("ref"), order_ref=F.col("ref"),
                   match_key=F.col("ref"), operation_type=F.lit("sale"), status=F.lit("settled"), currency=F.lit("EUR"),
                   amount_local=F.col("amount"), amount_local_settled=F.col("amount"), amount_local_duplicate=F.col("dup"),
                   fee_local=F.round(F.col("amount") * F.lit(D("0.025")), 2), created_at_utc=at, settled_at_utc=at)


def test_order_is_irrelevant_and_one_more_row_moves_gross_by_its_value(spark, rates):
    ledger = [ledger_row(f"o{i}", amount=f"{i + 1}.00", currency="EUR", rate="1.1") for i in range(12)]
    rows = [(f"o{i}", D(f"{i + 1}.00"), None) for i in range(12)]

    def table(df):
        return {(r.recon_scope, r.recon_cause): (r.n_rows, r.signed_usd, r.base_usd) for r in df.collect()}

    plain = table(pair(spark, rates, ledger, provider_rows(spark, rows)))
    assert plain == table(pair(spark, rates, ledger[::-1], provider_rows(spark, rows[::-1])))
    assert plain["gross", "matched"] == (12, D("0.00"), D("85.80"))
    more = table(pair(spark, rates, ledger, provider_rows(spark, [*rows, ("new", D("100.00"), None)])))
    assert more["gross", "psp_claims_sale"] == (1, D("110.00"), D("195.80"))
    assert more["gross", "matched"][:2] == plain["gross", "matched"][:2]
    twice = table(pair(spark, rates, ledger, provider_rows(spark, [("o0", D("1.00"), D("1.00")), *rows[1:]])))
    assert twice["gross", "psp_claims_duplicate_row"] == (1, D("1.10"), D("86.90"))


def test_contract_with_fixed_fee(spark, rates):
    contracts = refdata.contract_spans(refdata.fee_contracts(spark.createDataFrame(
        [("adyen", "EU", "2026-01-01", "2.5", "0.00", ""), ("adyen", "EU", "2026-06-05", "3.0", "0.10", "EUR"),
         ("adyen", "EU", "2026-06-11", "9.0", "0.10", "USD")],
        "psp string, account string, valid_from string, percent_fee string, fixed_fee string, fixed_fee_currency string")))
    priced = pricing.price_providers(provider_rows(spark, [("a", D("10.00"), None)]), rates)
    row = pricing.apply_contracts(priced, contracts).first()
    assert (row.percent_fee, row.fee_local_contracted, row.fee_usd_contracted) == (D("3.0000"), D("0.40"), D("0.44"))
    assert RunConfig().max_broadcast_rows > 0

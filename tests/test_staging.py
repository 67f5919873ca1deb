"""One literal export per provider, holding the edge cases that decide money."""

from datetime import date, datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerloom.config import CONFORMED, RunConfig
from ledgerloom.operators import quality, refdata, staging

ADYEN = ["Merchant Account", "Psp Reference", "Merchant Reference", "Record Type", "Creation Date", "Gross Currency",
         "Gross Credit", "Gross Debit", "Commission", "Markup", "Net Credit", "Net Debit", "Batch Number"]
DLOCAL = ["transaction_id", "invoice_id", "transaction_type", "status", "created_at_utc", "country", "currency",
          "currency_exponent", "local_amount", "fx_rate", "usd_amount", "fee_usd"]
GOOGLE = ["Transaction Date", "Transaction Time", "Transaction Type", "Product ID", "Buyer Country", "Buyer Currency",
          "Amount (Buyer Currency)", "Currency Conversion Rate", "Merchant Currency", "Amount (Merchant Currency)"]
PAYPAL = ["account", "Date", "Time", "Time Zone", "Type", "Status", "Currency", "Gross", "Fee", "Net", "Transaction ID",
          "Reference Txn ID", "Invoice ID"]


def frame(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def adyen_rows(spark):
    head = ["EU", "P1"]
    return frame(spark, ADYEN, [
        [*head, "O1", "Authorised", "2026-06-28 12:00:00", "EUR", "58.40", None, None, None, None, None, "1"],
        [*head, "O1", "Settled", "2026-07-02 12:00:00", "EUR", "36.00", None, "0.60", "0.30", "35.10", None, "1"],
        [*head, "O1", "Refunded", "2026-07-03 12:00:00", "EUR", None, "5.00", None, None, None, "5.00", "1"],
        [*head, "O2", "Refused", "2026-06-01 12:00:00", "EUR", "9.99", None, None, None, None, None, "1"],
        [*head, "O3", "Authorised", "2026-06-01 10:00:00", "EUR", "1.00", None, None, None, None, None, "1"],
        [*head, "O3", "Authorised", "2026-06-01 11:00:00", "EUR", "2.00", None, None, None, None, None, "1"],
        [*head, "O3", "Settled", "2026-06-01 12:00:00", "EUR", "2.00", None, None, None, "2.00", None, "1"],
        [*head, "O4", "Chargeback", "2026-06-01 12:00:00", "EUR", None, "7.00", None, None, None, "7.00", "1"],
        [*head, None, "Settled", "2026-06-01 12:00:00", "EUR", "3.00", None, None, None, "3.00", None, "1"]])


def test_adyen_lifecycle(spark):
    df = staging.adyen(adyen_rows(spark))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CONFORMED.fields]
    rows = {(r.order_ref, r.operation_type, r.status): r for r in df.collect()}
    assert len(rows) == df.count() == 6  # two authorisations of O3 do not fan out
    sale = rows["O1", "sale", "settled"]
    assert (sale.amount_local, sale.amount_local_settled, sale.amount_local_authorised) == (D("36.00"), D("36.00"), D("58.40"))
    assert (sale.fee_local, sale.net_local) == (D("0.90"), D("35.10"))
    assert (sale.created_at_utc, sale.settled_at_utc) == (datetime(2026, 6, 28, 10), datetime(2026, 7, 2, 10))
    refund = rows["O1", "refund", "settled"]
    assert (refund.amount_local, refund.net_local, refund.amount_local_authorised) == (D("-5.00"), D("-5.00"), None)
    declined = rows["O2", "sale", "declined"]
    assert (declined.amount_local, declined.amount_local_settled, declined.settled_at_utc) == (D("9.99"), D("0.00"), None)
    assert rows["O3", "sale", "settled"].amount_local_authorised == D("2.00")
    assert rows["O4", "chargeback", "settled"].amount_local_settled == D("-7.00")
    assert rows[None, "sale", "settled"].amount_local_authorised is None  # a blank reference matches nothing
    assert quality.authorised_not_double_counted(adyen_rows(spark), df).count() == 0


def test_dlocal_units_duplicates_and_disputes(spark):
    twice = ["T1", "O1", "PAYMENT", "PAID", "2026-06-01 00:00:00", "BR", "BRL", "2", "1990", "5.000000", "3.98", "0.18"]
    back = ["T1", "O1", "REFUND", "REFUNDED", "2026-06-02 00:00:00", "BR", "BRL", "2", "500", "5.000000", "1.00", "0.00"]
    raw = frame(spark, DLOCAL, [
        twice, twice, twice, back, back,
        ["T2", "O2", "PAYMENT", "PAID", "2026-06-01 00:00:00", "CL", "CLP", "0", "9900", "900.000000", "11.00", "0.50"],
        ["T3", "O3", "PAYMENT", "IN_MEDIATION", "2026-06-01 00:00:00", "MX", "MXN", "2", "12900", "18.000000", "7.17", "0.32"],
        ["T4", "O4", "PAYMENT", "REJECTED", "2026-06-01 00:00:00", "MX", "MXN", "2", "100", "18.000000", "0.06", "0.01"]])
    df = staging.dlocal(raw)
    rows = {(r.order_ref, r.operation_type): r for r in df.collect()}
    assert df.count() == 5
    assert (rows["O1", "sale"].amount_local, rows["O1", "sale"].amount_local_duplicate) == (D("19.90"), D("39.80"))
    # a repeated refund takes its surplus off, it does not add
    assert rows["O1", "refund"].amount_local_duplicate == D("-5.00")
    assert rows["O2", "sale"].amount_local == D("9900.00")
    assert (rows["O3", "sale"].status, rows["O3", "sale"].amount_local_settled) == ("disputed", D("0.00"))
    assert (rows["O4", "sale"].status, rows["O4", "sale"].settled_at_utc) == ("declined", None)
    assert quality.minor_units_scaled(raw, df).count() == 0
    assert quality.repeated_lines_are_identical(raw).count() == 0
    odd = raw.unionByName(frame(spark, DLOCAL, [[*twice[:-1], "0.19"]]))
    assert quality.repeated_lines_are_identical(odd).count() == 1
    blanket = raw.withColumn("currency_exponent", F.lit("2"))
    assert [r.psp_reference for r in quality.minor_units_scaled(blanket, staging.dlocal(blanket)).collect()] == ["T2"]


def test_google_play_folds_fees_and_keeps_collisions_apart(spark):
    def entry(time, kind, sku, country, amount, usd):
        return ["Jul 1, 2026", time, kind, sku, country, "EUR", amount, "1.08", "USD", usd]

    raw = frame(spark, GOOGLE, [
        entry("03:50:07", "Charge", "m", "DE", "9.99", "10.84"), entry("03:50:07", "Google fee", "m", "DE", "-1.50", "-1.63"),
        entry("03:50:07", "Charge", "y", "FR", "99.00", "106.92"), entry("03:50:07", "Google fee", "y", "FR", "-14.85", "-16.04"),
        entry("04:00:00", "Charge refund", "m", "DE", "-9.99", "-10.84"),
        entry("05:00:00", "Charge", "m", "DE", "9.99", "10.84")])
    df = staging.google_play(raw, RunConfig(google_play_account="acc"))
    rows = {(r.match_key, r.operation_type): r for r in df.collect()}
    assert df.count() == 4
    sale = rows["2026-07-01T10:50:07|m|DE", "sale"]
    assert (sale.fee_local, sale.fee_usd_native, sale.psp_account) == (D("1.50"), D("1.63"), "acc")
    assert rows["2026-07-01T10:50:07|y|FR", "sale"].fee_local == D("14.85")
    assert rows["2026-07-01T11:00:00|m|DE", "refund"].fee_local is None
    assert rows["2026-07-01T12:00:00|m|DE", "sale"].fee_local is None
    found = quality.fee_rows_folded(raw).collect()
    assert [(r.event_ts, r.n_charge, r.n_fee) for r in found] == [("Jul 1, 2026 05:00:00", 1, 0)]


def test_google_play_pairs_repeated_fees_in_order(spark):
    """Two charges and three fees of one key: every fee counts once, none is doubled or lost."""
    def entry(kind, amount):
        return ["Jul 1, 2026", "03:50:07", kind, "m", "DE", "EUR", amount, "1.00", "USD", amount]

    raw = frame(spark, GOOGLE, [entry("Charge", "20.00"), entry("Charge", "10.00"), entry("Google fee", "-3.00"),
                                entry("Google fee", "-1.50"), entry("Google fee", "-0.25")])
    rows = staging.google_play(raw, RunConfig()).collect()
    assert sorted((r.amount_local, r.fee_local) for r in rows) == [(D("10.00"), D("1.75")), (D("20.00"), D("3.00"))]


def test_google_play_fold_is_dealt_to_tasks_by_rows(spark):
    """However large the export, a task sorts a bounded number of rows, once to number and once to fold them."""
    def entry(second, kind, amount, usd):
        return ["Jul 1, 2026", f"03:00:{second:02d}", kind, "m", "DE", "EUR", amount, "1.00", "USD", usd]

    rows = []
    for second in range(60):
        rows += [entry(second, "Charge", f"{second + 10}.00", "1.00"), entry(second, "Google fee", "-1.50", "-0.15")]
        rows += [entry(second, "Charge", f"{second + 5}.00", "1.00")] * (second % 3)
        rows += [entry(second, "Google fee", "-0.25", "-0.02")] * (second % 4) + [entry(second, "Charge refund", "-2.00", "-2.00")]
        # neither a charge nor a fee, nor anything at all, and a key with fees only
        rows += [entry(second, "Adjustment", "900.00", "900.00"), entry(second, None, "800.00", "800.00")]
        rows += [["Jul 2, 2026", f"03:00:{second:02d}", "Google fee", "m", None, "EUR", "-1.00", "1.00", "USD", "-1.00"]]
    raw = frame(spark, GOOGLE, rows)
    small, large = RunConfig(fold_rows_per_task=10), RunConfig()
    folded = staging.google_play(raw, small)
    assert folded.rdd.getNumPartitions() == -(-len(rows) // 10) > staging.google_play(raw, large).rdd.getNumPartitions()
    plan = folded._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("Sort [") == 2 and initial.count("Exchange ") == 1, initial

    expected = []
    for second in range(60):
        charges = [second + 10] + [second + 5] * (second % 3)
        fees = [D("1.50")] + [D("0.25")] * (second % 4)
        for k, charge in enumerate(charges):
            own = fees[k:k + 1] if k < len(charges) - 1 else fees[k:]
            expected.append((second, "sale", D(charge), sum(own) if own else None))
        expected.append((second, "refund", D("-2.00"), None))
    for config in (small, large):
        got = [(r.created_at_utc.second, r.operation_type, r.amount_local, r.fee_local) for r in staging.google_play(raw, config).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, [(s, o, a.quantize(D("1.00")), f) for s, o, a, f in expected]))


def test_paypal_dialects_dates_and_copies(spark):
    us = ["paypal_us", "06/28/2026", "10:00:00", "GMT", "Website Payment", "Completed", "USD", "9.99", "-0.84", "9.15", "A", "", "O1"]
    raw = frame(spark, PAYPAL, [
        us, us,
        ["paypal_eu", "28/06/2026", "10:00:00", "GMT", "Website Payment", "Completed", "EUR", "1009,99", "-29,64", "980,35", "B", "", "O2"],
        ["paypal_eu", "06/15/2026", "10:00:00", "GMT", "Website Payment", "Denied", "EUR", "9,99", "0,00", "0,00", "C", "", "O3"],
        # month first inside a day-first file: 5 December lies outside the window, 12 May does too
        ["paypal_eu", "06/05/2026", "10:00:00", "GMT", "Refund", "Refunded", "EUR", "-5,00", "0,00", "-5,00", "D", "B", "O2"],
        ["paypal_eu", "05/12/2026", "10:00:00", "GMT", "Payment Reversal", "Reversed", "GBP", "-5,00", "0,00", "-5,00", "E", "X", "O9"]])
    start, end = F.lit(date(2026, 6, 1)), F.lit(date(2026, 7, 3))
    typed = {r.psp_reference: r for r in staging.paypal_typed(raw, start, end).collect()}
    assert typed["C"].event_at == datetime(2026, 6, 15, 10) and typed["C"].date_format_overridden
    assert typed["D"].event_at == datetime(2026, 6, 5, 10) and typed["D"].date_format_overridden
    assert typed["E"].date_unresolved and not typed["D"].date_unresolved
    df = staging.paypal(raw, start, end)
    rows = {r.psp_reference: r for r in df.collect()}
    assert df.count() == 5
    assert rows["A"].amount_local_duplicate == D("9.99") and rows["B"].amount_local_duplicate is None
    assert (rows["B"].amount_local, rows["B"].fee_local) == (D("1009.99"), D("29.64"))
    assert (rows["C"].status, rows["C"].amount_local_settled) == ("declined", D("0.00"))
    assert (rows["A"].related_psp_reference, rows["D"].related_psp_reference) == (None, "B")
    assert sorted(r.psp_reference for r in quality.reversals_resolve(df).collect()) == ["D", "E"]
    assert quality.paypal_fee_is_tariff(df).count() == 0
    assert quality.declared_zone_is_gmt(raw).count() == 0
    pinned = spark.createDataFrame([("O3",), ("O2",), ("O9",)], "order_ref string")
    assert quality.date_override_bounded(df, pinned).count() == 0
    fewer = spark.createDataFrame([("O3",)], "order_ref string")
    assert sorted(r.psp for r in quality.date_override_bounded(df, fewer).collect()) == [
        "expected_override_count", "paypal_eu", "paypal_eu"]


def test_rate_versions_rank_republications(spark):
    raw = spark.createDataFrame([
        ("2026-06-10", "BRL", "0.185352", "2026-06-10T16:00:00Z"), ("2026-06-10", "BRL", "0.190542", "2026-06-12T09:00:00Z"),
        ("2026-06-10", "EUR", "1.08", "2026-06-10T16:00:00Z"),
        ("2026-06-11", "EUR", "1.09", "2026-06-11T16:00:00Z"), ("2026-06-11", "EUR", "1.07", "2026-06-11T16:00:00Z")],
        "rate_date string, currency string, usd_rate string, published_at string")
    versions = refdata.rate_versions(raw)
    current = {(str(r.rate_date), r.currency): r.usd_rate for r in refdata.current_rates(versions).collect()}
    assert current == {("2026-06-10", "BRL"): D("0.190542"), ("2026-06-10", "EUR"): D("1.080000"),
                       ("2026-06-11", "EUR"): D("1.090000")}
    assert quality.rate_grain(versions).count() == 0


def test_conform_union_drops_what_only_some_providers_have(spark):
    raw = frame(spark, PAYPAL, [["paypal_us", "06/28/2026", "10:00:00", "GMT", "Refund", "Refunded", "USD", "-1.00", "0.00",
                                 "-1.00", "A", "B", "O1"]])
    paypal = staging.paypal(raw, F.lit(date(2026, 6, 1)), F.lit(date(2026, 7, 3)))
    both = staging.conform_union(staging.adyen(adyen_rows(spark)), paypal)
    assert both.columns == CONFORMED.fieldNames() and both.count() == 7

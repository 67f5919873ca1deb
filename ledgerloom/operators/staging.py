"""One function per export: all-string rows in the provider's own dialect to the conformed shape.

Amounts leave signed (reversals negative), times in UTC, and each row carries a match key made of its
own columns only, so the provider's account stays independent of the ledger's.
"""

from __future__ import annotations

from collections.abc import Mapping
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.config import CONFORMED, MONEY, RATE, RunConfig
from ledgerloom.functions import money, text, time
from ledgerloom.operators.folding import attach_summary, collapse_copies, split_fee_sum, surplus_of

# Provider verbs and their meaning.
ADYEN_OUTCOMES = {"Settled": "sale", "Refused": "sale", "Refunded": "refund", "Chargeback": "chargeback"}
DLOCAL_STATUSES = {"PAID": "settled", "REFUNDED": "settled", "REJECTED": "declined", "IN_MEDIATION": "disputed"}
GOOGLE_OPERATIONS = {"Charge": "sale", "Charge refund": "refund"}
PAYPAL_OPERATIONS = {"Website Payment": "sale", "Refund": "refund", "Payment Reversal": "chargeback"}
PAYPAL_STATUSES = {"Completed": "settled", "Refunded": "settled", "Reversed": "settled", "Denied": "declined"}

# The zone each export writes its times in; the others write UTC.
ADYEN_ZONE = "Europe/Amsterdam"
GOOGLE_ZONE = "America/Los_Angeles"


def conform(df: DataFrame, extra: tuple[str, ...] = (), **columns: Column) -> DataFrame:
    """Project to the conformed schema; columns a provider does not publish become typed nulls."""
    fields = [
        columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in CONFORMED.fields]
    return df.select(*fields, *[columns.get(c, F.col(c)).alias(c) for c in extra])


def ledger(raw: DataFrame) -> DataFrame:
    """The internal payment log, typed; amounts stay positive as booked."""
    return raw.select(
        "txn_id", "order_id",
        F.lower("operation_type").alias("operation_type"),
        F.lower("status").alias("status"),
        "psp", "psp_reference", "sku", "country", "currency",
        F.col("amount_local").cast(MONEY).alias("amount_local"),
        F.col("fx_rate_applied").cast(RATE).alias("fx_rate_applied"),
        F.col("fx_date_applied").cast("date").alias("fx_date_applied"),
        F.col("amount_usd").cast(MONEY).alias("amount_usd"),
        time.utc(F.col("created_at_utc")).alias("created_at_utc"),
        time.utc(F.col("captured_at_utc")).alias("captured_at_utc"))


def adyen_events(raw: DataFrame) -> DataFrame:
    amount = {name: F.col(header).cast(MONEY).alias(name) for name, header in {
        "gross_credit": "`Gross Credit`", "gross_debit": "`Gross Debit`",
        "commission": "Commission", "markup": "Markup",
        "net_credit": "`Net Credit`", "net_debit": "`Net Debit`"}.items()}
    return raw.select(
        F.col("`Merchant Account`").alias("psp_account"),
        F.col("`Psp Reference`").alias("psp_reference"),
        F.col("`Merchant Reference`").alias("order_ref"),
        F.col("`Record Type`").alias("record_type"),
        time.local_to_utc(time.utc(F.col("`Creation Date`")), ADYEN_ZONE).alias("event_at"),
        F.col("`Gross Currency`").alias("currency"),
        *amount.values(),
        F.col("`Batch Number`").cast("int").alias("batch_number"))


def adyen(raw: DataFrame) -> DataFrame:
    """Fold the payment lifecycle: one row per outcome, the authorisation attached to its settlement."""
    events = adyen_events(raw)
    outcomes = events.filter(F.col("record_type").isin(*ADYEN_OUTCOMES))
    authorised = events.filter(F.col("record_type") == "Authorised").select(
        "order_ref", F.struct("event_at", "gross_credit").alias("authorisation"))
    # of several authorisations of one order the last one is in force
    folded = attach_summary(outcomes, authorised, ["order_ref"], authorisation=F.max("authorisation"))
    settled, refused = F.col("record_type") == "Settled", F.col("record_type") == "Refused"
    amount = F.when(settled | refused, F.col("gross_credit")).otherwise(-F.col("gross_debit"))

    def if_moved(value: Column) -> Column:
        return F.when(~refused, value)

    return conform(
        folded,
        psp=F.lit("adyen"),
        psp_account=F.col("psp_account"),
        psp_reference=F.col("psp_reference"),
        order_ref=F.col("order_ref"),
        match_key=F.col("order_ref"),
        operation_type=text.vocabulary(F.col("record_type"), ADYEN_OUTCOMES),
        status=F.when(refused, "declined").otherwise("settled"),
        currency=F.col("currency"),
        amount_local=amount,
        amount_local_settled=F.when(refused, money.zero()).otherwise(amount),
        amount_local_authorised=F.when(settled, F.col("authorisation.gross_credit")),
        fee_commission_local=if_moved(F.col("commission")),
        fee_markup_local=if_moved(F.col("markup")),
        fee_local=split_fee_sum(if_moved(F.col("commission")), if_moved(F.col("markup"))),
        net_local=F.when(settled, F.col("net_credit")).when(~refused, -F.col("net_debit")),
        created_at_utc=F.when(settled, F.col("authorisation.event_at")).otherwise(F.col("event_at")),
        settled_at_utc=if_moved(F.col("event_at")),
        batch_number=F.col("batch_number"))


def dlocal_typed(raw: DataFrame) -> DataFrame:
    """Distinct export lines with their copy count, amounts in major units."""
    exponent = F.col("currency_exponent").cast("int")
    return collapse_copies(raw).select(
        F.col("transaction_id").alias("psp_reference"),
        F.col("invoice_id").alias("order_ref"),
        "transaction_type",
        F.col("status").alias("psp_status"),
        time.utc(F.col("created_at_utc")).alias("event_at"),
        "country", "currency",
        exponent.alias("currency_exponent"),
        money.from_minor_units(F.col("local_amount").cast("decimal(24,4)"), exponent).alias("amount"),
        F.col("fx_rate").cast(RATE).alias("fx_rate_local_per_usd"),
        F.col("usd_amount").cast(MONEY).alias("usd_amount_reported"),
        F.col("fee_usd").cast(MONEY).alias("fee_usd_reported"),
        "n_copies")


def dlocal(raw: DataFrame) -> DataFrame:
    rows = dlocal_typed(raw)
    is_refund = F.col("transaction_type") == "REFUND"
    status = text.vocabulary(F.col("psp_status"), DLOCAL_STATUSES)
    signed = F.when(is_refund, -F.col("amount")).otherwise(F.col("amount"))
    moved = F.when(status != "settled", money.zero()).otherwise(signed)
    return conform(
        rows,
        psp=F.lit("dlocal"),
        psp_reference=F.col("psp_reference"),
        order_ref=F.col("order_ref"),
        match_key=F.col("order_ref"),
        operation_type=F.when(is_refund, "refund").otherwise("sale"),
        status=status,
        currency=F.col("currency"),
        amount_local=signed,
        amount_local_settled=moved,
        amount_local_duplicate=surplus_of(moved, F.col("n_copies")),
        fee_usd_native=F.col("fee_usd_reported"),
        created_at_utc=F.col("event_at"),
        settled_at_utc=F.when(status == "settled", F.col("event_at")))


def google_play_entries(raw: DataFrame) -> DataFrame:
    local = time.worded_date(F.col("`Transaction Date`"), F.col("`Transaction Time`"))
    return raw.select(
        time.local_to_utc(local, GOOGLE_ZONE).alias("event_at"),
        F.col("`Transaction Type`").alias("entry"),
        F.col("`Product ID`").alias("sku"),
        F.col("`Buyer Country`").alias("country"),
        F.col("`Buyer Currency`").alias("currency"),
        F.col("`Amount (Buyer Currency)`").cast(MONEY).alias("amount"),
        F.col("`Amount (Merchant Currency)`").cast(MONEY).alias("amount_usd"))


def google_play(raw: DataFrame, config: RunConfig = RunConfig()) -> DataFrame:
    """Fold each sibling fee entry into its charge as a positive cost.

    Charge and fee share second, product and country. Where that repeats, the k-th fee belongs to the k-th charge
    by size; fees beyond the number of charges go to the last one, so the fees of a key count once whatever repeats.
    One shuffle: the numbering and the fold both group by the shared key. Each of them sorts the rows of a task in
    memory, and Spark sizes tasks by compressed bytes, of which these rows have few. So the export is counted here and
    dealt to tasks of ``config.fold_rows_per_task`` rows; it should be stored, or cheap to count.
    """
    keys = ["event_at", "sku", "country"]
    parts = max(raw.sparkSession.sparkContext.defaultParallelism, ceil(raw.count() / config.fold_rows_per_task))
    entries = google_play_entries(raw).repartition(parts, *keys)
    is_fee, is_charge = F.col("entry") == "Google fee", F.col("entry") == "Charge"
    # charges first, so they are places 1 to n of their key and all are counted when the fees come
    kind = F.when(is_charge, 0).when(is_fee, 1).otherwise(2)
    by_size = Window.partitionBy(*keys).orderBy(kind, F.abs("amount").desc(), F.abs("amount_usd").desc())
    charges = F.count(F.when(is_charge, 1)).over(by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = entries.withColumns({"place": F.row_number().over(by_size), "charges": charges})
    paired = placed.withColumn(
        "place", F.when(is_fee, F.least(F.col("place") - F.col("charges"), "charges")).otherwise(F.col("place"))).drop("charges")
    first = {c: F.max(F.when(~is_fee, F.col(c))) for c in ("currency", "amount", "amount_usd")}
    folded = (paired.groupBy(*keys, "place").agg(
        F.max(F.when(~is_fee, F.col("entry"))).alias("entry"), first["currency"].alias("currency"),
        first["amount"].alias("paid"), first["amount_usd"].alias("paid_usd"),
        F.sum(F.when(is_fee, -F.col("amount"))).alias("fee"), F.sum(F.when(is_fee, -F.col("amount_usd"))).alias("fee_usd"))
        .filter(F.col("entry").isin(*GOOGLE_OPERATIONS)))
    is_sale = F.col("entry") == "Charge"
    return conform(
        folded,
        psp=F.lit("google_play"),
        psp_account=F.lit(config.google_play_account),
        match_key=text.composite_key(F.col("event_at"), F.col("sku"), F.col("country")),
        operation_type=text.vocabulary(F.col("entry"), GOOGLE_OPERATIONS),
        status=F.lit("settled"),
        currency=F.col("currency"),
        amount_local=F.col("paid"),
        amount_local_settled=F.col("paid"),
        fee_local=F.when(is_sale, F.col("fee")),
        fee_usd_native=F.when(is_sale, F.col("fee_usd")),
        created_at_utc=F.col("event_at"),
        settled_at_utc=F.col("event_at"))


def resolve_dual_date(
    df: DataFrame, day: Column, clock: Column, month_first: Column,
    window_start: Column, window_end: Column,
) -> DataFrame:
    """Read a day/month date in its file's declared order; where that falls outside the export's own
    window, or is no date at all, read it in the other order and say so."""
    mdy, dmy = (time.clock_time(F.col("__parts"), order) for order in ("mdy", "dmy"))
    declared = F.when(month_first, F.col("__mdy")).otherwise(F.col("__dmy"))
    other = F.when(month_first, F.col("__dmy")).otherwise(F.col("__mdy"))

    def inside(ts: Column) -> Column:
        return F.coalesce(time.day_of(ts).between(window_start, window_end), F.lit(False))

    return (df.withColumn("__parts", time.clock_parts(day, clock))
            .withColumns({"__mdy": mdy, "__dmy": dmy})
            .withColumns({"__declared": declared, "__other": other})
            .withColumns({
                "date_format_overridden": ~inside(F.col("__declared")),
                "event_at": F.when(inside(F.col("__declared")), F.col("__declared"))
                             .otherwise(F.col("__other")),
                "date_unresolved": ~inside(F.col("__declared")) & ~inside(F.col("__other"))})
            .drop("__parts", "__mdy", "__dmy", "__declared", "__other"))


def tag_accounts(exports: Mapping[str, DataFrame]) -> DataFrame:
    """The account is the file: tag each export with its account and stack them by column name."""
    stacked = None
    for account, df in exports.items():
        tagged = df.withColumn("account", F.lit(account))
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    return stacked


def paypal_typed(raw: DataFrame, window_start: Column, window_end: Column) -> DataFrame:
    """Distinct export lines of all accounts with their copy count; needs an ``account`` column."""
    dated = resolve_dual_date(
        collapse_copies(raw), F.col("Date"), F.col("Time"), F.col("account") == "paypal_us",
        window_start, window_end)
    return dated.select(
        "account",
        F.col("`Transaction ID`").alias("psp_reference"),
        text.blank_to_null(F.col("`Reference Txn ID`")).alias("related_psp_reference"),
        F.col("`Invoice ID`").alias("order_ref"),
        text.vocabulary(F.col("Type"), PAYPAL_OPERATIONS).alias("operation_type"),
        text.vocabulary(F.col("Status"), PAYPAL_STATUSES).alias("status"),
        F.col("Currency").alias("currency"),
        text.money(F.col("Gross")).alias("gross"),
        text.money(F.col("Fee")).alias("fee"),
        text.money(F.col("Net")).alias("net"),
        "event_at", "date_format_overridden", "date_unresolved", "n_copies")


def paypal(raw: DataFrame, window_start: Column, window_end: Column) -> DataFrame:
    rows = paypal_typed(raw, window_start, window_end)
    settled = F.col("status") == "settled"
    moved = F.when(settled, F.col("gross")).otherwise(money.zero())
    return conform(
        rows,
        extra=("related_psp_reference", "date_format_overridden"),
        psp=F.col("account"),
        psp_account=F.col("account"),
        psp_reference=F.col("psp_reference"),
        order_ref=F.col("order_ref"),
        match_key=F.col("order_ref"),
        operation_type=F.col("operation_type"),
        status=F.col("status"),
        currency=F.col("currency"),
        amount_local=F.col("gross"),
        amount_local_settled=moved,
        amount_local_duplicate=surplus_of(moved, F.col("n_copies")),
        fee_local=-F.col("fee"),
        net_local=F.col("net"),
        created_at_utc=F.col("event_at"),
        settled_at_utc=F.when(settled, F.col("event_at")))


def conform_union(*providers: DataFrame) -> DataFrame:
    """All providers as one relation; columns only some of them have are dropped."""
    names = CONFORMED.fieldNames()
    stacked = providers[0]
    for other in providers[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked.select(*names)


def export_keys(adyen_raw: DataFrame, dlocal_raw: DataFrame, google_play_raw: DataFrame, paypal_raw: DataFrame) -> DataFrame:
    """Provider, match key and operation of every export line, before any folding: a scan of a few
    columns, cheap enough to look for heavy keys."""
    def keys(df: DataFrame, psp: Column, match_key: Column, operation: Column) -> DataFrame:
        return df.select(psp.alias("psp"), match_key.alias("match_key"), operation.alias("operation_type"))

    google = google_play_entries(google_play_raw)
    return (keys(adyen_raw, F.lit("adyen"), F.col("`Merchant Reference`"),
                 text.vocabulary(F.col("`Record Type`"), ADYEN_OUTCOMES))
            .unionByName(keys(dlocal_raw, F.lit("dlocal"), F.col("invoice_id"),
                              F.when(F.col("transaction_type") == "REFUND", "refund").otherwise("sale")))
            .unionByName(keys(google, F.lit("google_play"), text.composite_key(
                F.col("event_at"), F.col("sku"), F.col("country")), text.vocabulary(F.col("entry"), GOOGLE_OPERATIONS)))
            .unionByName(keys(paypal_raw, F.col("account"), F.col("`Invoice ID`"),
                              text.vocabulary(F.col("Type"), PAYPAL_OPERATIONS))))

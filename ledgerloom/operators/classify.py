"""One root cause per row in each of three scopes.

The rules are data: ordered lists of (cause, condition) where the first condition that holds names
the cause. The order carries meaning and is part of the specification.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import money

Rule = tuple[Column | str, Column]


def first_match(rules: Sequence[Rule], otherwise: Column | None = None) -> Column:
    chain = None
    for cause, condition in rules:
        label = F.lit(cause) if isinstance(cause, str) else cause
        chain = F.when(condition, label) if chain is None else chain.when(condition, label)
    return chain if otherwise is None else chain.otherwise(otherwise)


def is_true(condition: Column) -> Column:
    """Null counts as false, so the negation is safe too."""
    return F.coalesce(condition, F.lit(False))


def scope_to_period(matched: DataFrame, period: date | None = None) -> DataFrame:
    """Count each side's money only in its own period.

    With a period, every row is kept and flagged. Without one, a row appears once per distinct period of the sides
    it has, which reports all periods in one pass; a side without a date is in the undated period, which is null.
    """
    if period is not None:
        rows = matched.withColumn("reporting_month", F.lit(period).cast("date"))
    else:
        only_ours, only_theirs = F.array("engine_period"), F.array("psp_period")
        own = (F.when(~F.col("in_psp"), only_ours).when(~F.col("in_engine"), only_theirs)
               .otherwise(F.array_distinct(F.array("engine_period", "psp_period"))))
        rows = matched.withColumn("reporting_month", F.explode(own))
    ours = F.col("in_engine") & F.col("engine_period").eqNullSafe(F.col("reporting_month"))
    theirs = F.col("in_psp") & F.col("psp_period").eqNullSafe(F.col("reporting_month"))

    def counted(flag: str, amount: str) -> Column:
        return F.when(F.col(flag), money.or_zero(F.col(amount))).otherwise(money.zero())

    return (rows
            .withColumns({"engine_in_period": ours, "psp_in_period": theirs})
            .withColumns({
                "in_period": F.col("engine_in_period") | F.col("psp_in_period"),
                "engine_amount_usd_period": counted("engine_in_period", "engine_amount_usd_settled"),
                "engine_amount_usd_booked_period": counted("engine_in_period", "engine_amount_usd_booked"),
                "psp_amount_usd_period": counted("psp_in_period", "psp_amount_usd_settled"),
                "psp_amount_usd_duplicate_period": counted("psp_in_period", "psp_amount_usd_duplicate")}))


def _settled_provider_sale() -> Column:
    return is_true((F.col("operation_type") == "sale") & (F.col("psp_status") == "settled"))


def scope_differences(scoped: DataFrame) -> DataFrame:
    """Signed differences; negative always means the ledger overstates what is kept."""
    charged = money.or_zero(F.col("psp_fee_usd"))
    contracted = F.col("fee_usd_contracted")
    fee_gap = (F.when(~F.col("psp_in_period"), money.zero())
               .when(contracted.isNotNull(), contracted - charged)
               .when(_settled_provider_sale(), -charged)
               .otherwise(money.zero()))
    return scoped.withColumns({
        "gross_diff_usd": (F.col("psp_amount_usd_period") + F.col("psp_amount_usd_duplicate_period")
                           - F.col("engine_amount_usd_period")),
        "bug_diff_usd": F.col("engine_amount_usd_period") - F.col("engine_amount_usd_booked_period"),
        "net_diff_usd": fee_gap})


def bug_cause() -> Column:
    reason = F.col("engine_fx_variance_reason")
    return first_match([
        ("matched", F.col("in_engine") & (reason == "none")),
        (F.concat(F.lit("engine_"), reason), F.col("in_engine"))])


def fee_cause() -> Column:
    """Charged against contracted, in local currency: converting first would add rounding noise.

    A provider that states its fee in USD only is compared in USD.
    """
    in_usd = F.col("psp_fee_local").isNull() & F.col("psp_fee_usd").isNotNull()
    charged = F.when(in_usd, F.col("psp_fee_usd")).otherwise(F.col("psp_fee_local"))
    agreed = F.when(in_usd, F.col("fee_usd_contracted")).otherwise(F.col("fee_local_contracted"))
    under_contract = F.col("fee_local_contracted").isNotNull()
    return first_match([
        ("psp_fee_missing", under_contract & charged.isNull()),
        ("psp_fee_overcharge", under_contract & (charged > agreed)),
        ("psp_fee_undercharge", under_contract & (charged < agreed)),
        ("matched", under_contract),
        ("psp_claims_fee_out_of_contract",
         _settled_provider_sale() & (money.or_zero(F.col("psp_fee_usd")) != 0)),
        ("fee_not_contracted", _settled_provider_sale())])


def gross_rules(report_silent_attempts: bool = False) -> list[Rule]:
    """``report_silent_attempts`` adds a cause of its own for ledger attempts that never settled and
    that the provider does not report; by default they fall through to the period rule."""
    in_ledger, at_provider = F.col("in_engine"), F.col("in_psp")
    ours, theirs = F.col("engine_status"), F.col("psp_status")
    booked, moved = F.col("engine_amount_local_settled"), F.col("psp_amount_local_settled")
    authorised = F.col("psp_amount_local_authorised")
    same_currency = F.col("psp_currency") == F.col("engine_currency")
    operation = F.col("operation_type")
    rules: list[Rule] = [
        (F.concat(F.lit("psp_claims_"), operation), ~in_ledger),
        (F.concat(F.lit("engine_claims_"), operation), ~at_provider & (ours == "settled")),
        ("psp_claims_declined", (ours == "settled") & (theirs == "declined")),
        ("psp_claims_disputed", (ours == "settled") & (theirs == "disputed")),
        # ahead of the period rule: the ledger has no capture at all here, not a different period
        ("engine_capture_not_recorded", (ours == "pending") & (theirs == "settled")),
        ("psp_claims_partial_capture", (moved != authorised) & (booked == authorised)),
        ("psp_claims_captured_different_period",
         ~F.col("engine_period").eqNullSafe(F.col("psp_period"))),
        ("psp_claims_duplicate_row",
         (F.col("psp_amount_usd_duplicate_period") != 0) & (moved == booked)),
        ("matched", F.col("gross_diff_usd") == 0),
        ("psp_fx_date_basis", same_currency & (moved == booked)),
        ("psp_claims_different_amount", same_currency & (ours == "settled") & (theirs == "settled")),
    ]
    if report_silent_attempts:
        rules.insert(2, ("engine_attempt_unreported", ~at_provider))
    return rules


def status_of(cause: str) -> Column:
    """Cause to status; no cause, no status."""
    c = F.col(cause)
    return F.when(c.isin("matched", "unexplained"), c).when(c.isNotNull(), F.lit("explained"))


def classify(scoped: DataFrame, report_silent_attempts: bool = False) -> DataFrame:
    caused = scope_differences(scoped).withColumns({
        "bug_cause": bug_cause(),
        "net_cause": fee_cause(),
        "gross_cause": first_match(gross_rules(report_silent_attempts), F.lit("unexplained"))})
    return caused.withColumns({
        f"{scope}_status": status_of(f"{scope}_cause") for scope in ("bug", "net", "gross")})

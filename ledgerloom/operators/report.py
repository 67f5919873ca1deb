"""Classified rows to the materiality summary and the closing waterfall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.config import BASE_LABELS, MONEY, TOTAL, WATERFALL_LINES
from ledgerloom.functions import money

_LINE_KEYS = ["reporting_month", "psp", "recon_scope", "recon_status", "recon_cause"]
_SCOPE_KEYS = ["reporting_month", "psp", "recon_scope"]


def _scope_entry(scope: str, present: Column, status: str, cause: str, diff: str, base: Column) -> Column:
    return F.when(present, F.struct(
        F.lit(scope).alias("recon_scope"),
        F.col(status).alias("recon_status"),
        F.col(cause).alias("recon_cause"),
        F.col(diff).cast(MONEY).alias("diff_usd"),
        base.cast(MONEY).alias("base_usd")))


def _scope_entries(classified: DataFrame) -> DataFrame:
    """One scan, up to three entries a row. An entry without a cause only adds to its scope's base:
    the base is the provider's whole book, not just the rows that carry a verdict."""
    entries = F.array(
        _scope_entry("backend_fx", F.col("engine_in_period"), "bug_status", "bug_cause", "bug_diff_usd",
                     F.col("engine_amount_usd_booked_period")),
        _scope_entry("gross", F.col("in_period"), "gross_status", "gross_cause", "gross_diff_usd",
                     F.col("psp_amount_usd_period") + F.col("psp_amount_usd_duplicate_period")),
        _scope_entry("fees", F.col("psp_in_period"), "net_status", "net_cause", "net_diff_usd",
                     money.or_zero(F.col("psp_fee_usd"))))
    return (classified.select("reporting_month", "psp", F.explode(entries).alias("e"))
            .filter("e is not null").select("reporting_month", "psp", "e.*"))


def scope_lines(classified: DataFrame) -> DataFrame:
    """Unpivot: one row per scope a transaction has a verdict in."""
    return _scope_entries(classified).filter("recon_cause is not null").drop("base_usd")


def materiality_bases(classified: DataFrame) -> DataFrame:
    """The book each scope is judged against, per provider."""
    totals = _scope_entries(classified).groupBy(*_SCOPE_KEYS).agg(F.sum("base_usd").cast(TOTAL).alias("base_usd"))
    return totals.withColumn("base_label", _base_label())


def _base_label() -> Column:
    label = F.lit(None).cast("string")
    for scope, words in BASE_LABELS.items():
        label = F.when(F.col("recon_scope") == scope, F.lit(words)).otherwise(label)
    return label


def _totals(entries: DataFrame) -> DataFrame:
    """All line totals and base contributions in one grouping; afterwards everything is a few rows
    per provider."""
    return entries.groupBy(*_LINE_KEYS).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.abs("diff_usd")).cast(TOTAL).alias("abs_usd"),
        F.sum("diff_usd").cast(TOTAL).alias("signed_usd"),
        F.sum("base_usd").cast(TOTAL).alias("base_part"))


def cause_rollup(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*_LINE_KEYS).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.abs("diff_usd")).cast(TOTAL).alias("abs_usd"),
        F.sum("diff_usd").cast(TOTAL).alias("signed_usd"))


def stated_residual(rollup: DataFrame) -> DataFrame:
    """The explicit zero line of every scope that has nothing unexplained."""
    unexplained = rollup.filter("recon_status = 'unexplained'").select(*_SCOPE_KEYS)
    silent = rollup.select(*_SCOPE_KEYS).distinct().join(unexplained, _SCOPE_KEYS, "left_anti")
    return silent.select(
        *_SCOPE_KEYS,
        F.lit("unexplained").alias("recon_status"), F.lit("unexplained").alias("recon_cause"),
        F.lit(0).cast("bigint").alias("n_rows"),
        F.lit(0).cast(TOTAL).alias("abs_usd"), F.lit(0).cast(TOTAL).alias("signed_usd"))


def _with_denominators(totals: DataFrame) -> DataFrame:
    """Beside each line: its scope's base, the scope's and the whole period's absolute discrepancy, and
    whether it is the one line of its scope that carries a missing residual."""
    scope, period = Window.partitionBy(*_SCOPE_KEYS), Window.partitionBy("reporting_month")
    has_verdict = F.col("recon_cause").isNotNull()
    verdict_usd = F.when(has_verdict, F.col("abs_usd"))
    name = F.struct("recon_cause", "recon_status")
    unexplained = F.count(F.when(F.col("recon_status") == "unexplained", 1)).over(scope)
    return totals.withColumns({
        "base_usd": F.sum("base_part").over(scope),
        "scope_abs_usd": F.sum(verdict_usd).over(scope),
        "period_abs_usd": F.sum(verdict_usd).over(period),
        "carries_residual": (unexplained == 0) & has_verdict & (F.min(F.when(has_verdict, name)).over(scope) == name)})


def materiality_shares(lines: DataFrame) -> DataFrame:
    """Shares of base, of the scope's discrepancy and of the period's whole discrepancy."""
    part = F.col("abs_usd")
    return lines.withColumns({
        "pct_of_base": money.share_percent(part, F.col("base_usd"), 4, "decimal(12,4)"),
        "pct_of_scope_discrepancy": money.share_percent(part, F.col("scope_abs_usd"), 2, "decimal(6,2)"),
        "pct_of_total_discrepancy": money.share_percent(part, F.col("period_abs_usd"), 2, "decimal(6,2)")})


def recon_summary(classified: DataFrame) -> DataFrame:
    """Provider x scope x cause with materiality, from a single scan of the classified rows."""
    # a few rows per provider from here on; placed by month, every window below finds its rows in place
    totals = _with_denominators(_totals(_scope_entries(classified)).repartition("reporting_month"))
    line = F.struct("recon_status", "recon_cause", "n_rows", "abs_usd", "signed_usd")
    nil = F.struct(
        F.lit("unexplained").alias("recon_status"), F.lit("unexplained").alias("recon_cause"),
        F.lit(0).cast("bigint").alias("n_rows"),
        F.lit(0).cast(TOTAL).alias("abs_usd"), F.lit(0).cast(TOTAL).alias("signed_usd"))
    lines = (totals
             .withColumn("line", F.explode(F.array(
                 F.when(F.col("recon_cause").isNotNull(), line), F.when(F.col("carries_residual"), nil))))
             .filter("line is not null")
             .select(*_SCOPE_KEYS, "line.*", _base_label().alias("base_label"), "base_usd", "scope_abs_usd",
                     "period_abs_usd"))
    return materiality_shares(lines).select(
        *_LINE_KEYS, "n_rows",
        F.col("abs_usd").cast(MONEY).alias("abs_usd"),
        F.col("signed_usd").cast(MONEY).alias("signed_usd"),
        "base_label", F.col("base_usd").cast(MONEY).alias("base_usd"),
        "pct_of_base", "pct_of_scope_discrepancy", "pct_of_total_discrepancy")


def waterfall_levels(summary: DataFrame) -> DataFrame:
    def base(scope: str) -> Column:
        return money.or_zero(F.max(F.when(F.col("recon_scope") == scope, F.col("base_usd"))))

    def moved(scope: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("recon_scope") == scope, F.col("signed_usd"))), money.zero())

    return summary.groupBy("reporting_month", "psp").agg(
        base("backend_fx").alias("backend_booked"),
        moved("backend_fx").alias("backend_fx_faults"),
        moved("gross").alias("provider_variance"),
        base("gross").alias("provider_gross"),
        base("fees").alias("provider_fees"))


def recon_waterfall(summary: DataFrame) -> DataFrame:
    """Seven lines per provider, from the summary alone."""
    level = {c: F.col(c) for c in (
        "backend_booked", "backend_fx_faults", "provider_variance", "provider_gross", "provider_fees")}
    value = {
        **level,
        "backend_restated": level["backend_booked"] + level["backend_fx_faults"],
        "provider_fees": -level["provider_fees"],
        "net_receipts": level["provider_gross"] - level["provider_fees"]}
    subtotals = {"backend_restated", "provider_gross", "net_receipts"}
    lines = F.array(*[
        F.struct(F.lit(seq).alias("line_seq"), F.lit(name).alias("line_item"),
                 value[name].cast(MONEY).alias("usd"), F.lit(name in subtotals).alias("is_subtotal"))
        for seq, name in enumerate(WATERFALL_LINES, start=1)])
    return (waterfall_levels(summary)
            .select("reporting_month", "psp", F.explode(lines).alias("l"))
            .select("reporting_month", "psp", "l.*"))


def reported_providers(waterfall: DataFrame) -> list[str]:
    """The providers of a waterfall by name: the columns of the printed report."""
    return sorted(r["psp"] for r in waterfall.select("psp").distinct().collect())


def waterfall_pivot_total(waterfall: DataFrame, providers: Sequence[str] = ()) -> DataFrame:
    """A column per provider, zero where it lacks the line, and the total over all rows.

    Without ``providers`` the columns are those the waterfall has; the total never depends on them.
    """
    keys = ["reporting_month", "line_seq", "line_item", "is_subtotal"]
    shown = list(providers) or reported_providers(waterfall)
    amount = {p: F.sum(F.when(F.col("psp") == p, F.col("usd"))) for p in shown}
    return waterfall.groupBy(*keys).agg(
        *[F.coalesce(a, money.zero()).cast(TOTAL).alias(p) for p, a in amount.items()],
        F.sum("usd").cast(TOTAL).alias("total"))


# Labels of the rendered report.
LINE_LABELS = {
    "backend_booked": "Backend booked", "backend_fx_faults": "Backend FX faults",
    "backend_restated": "Backend restated", "provider_variance": "Provider variance",
    "provider_gross": "Provider gross", "provider_fees": "Provider fees", "net_receipts": "Net receipts"}


def rendered_waterfall(pivoted: DataFrame, providers: Sequence[str] = ()) -> DataFrame:
    """The pivot in accounting notation; subtotals and the total column are set in bold marks."""
    def bold(cell: Column) -> Column:
        return F.when(cell == "—", cell).otherwise(F.concat(F.lit("**"), cell, F.lit("**")))

    fixed = ("reporting_month", "line_seq", "line_item", "is_subtotal", "total")
    providers = list(providers) or [c for c in pivoted.columns if c not in fixed]
    label = F.lit(None).cast("string")
    for item, words in LINE_LABELS.items():
        label = F.when(F.col("line_item") == item, F.lit(words)).otherwise(label)
    cells = {p: money.accounting(F.col(p)) for p in providers}
    return pivoted.select(
        "reporting_month", "line_seq",
        F.when(F.col("is_subtotal"), F.concat(F.lit("**"), label, F.lit("**"))).otherwise(label).alias("line"),
        *[F.when(F.col("is_subtotal"), bold(c)).otherwise(c).alias(p) for p, c in cells.items()],
        F.concat(F.lit("**"), money.accounting(F.col("total")), F.lit("**")).alias("total"))

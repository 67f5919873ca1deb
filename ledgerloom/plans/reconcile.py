"""One reconciliation run: provider exports and the payment log in, report tables and files out.

Written tables cut the plan where a layer is read more than once: staged exports, the priced sides,
the classified rows. Each lies under the output folder, so a lost executor never costs a whole run.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import RunConfig
from ledgerloom.operators import classify, matching, pricing, quality, refdata, report, staging
from ledgerloom.sources import normalise, registry, sinks
from ledgerloom.sources.registry import SourceSpec
from ledgerloom.sources.workspace import fresh_path, settle, write_table

REQUIRED = ("payment_engine_log", "paypal_us_activity", "paypal_eu_activity", "adyen_payment_accounting",
            "dlocal_transactions", "google_play_earnings", "fx_rates", "fee_schedule")


@dataclass
class Run:
    """The tables of a run by name, where the report files went, and the checks that found violations."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    files: dict[str, str] = field(default_factory=dict)
    failed: list[str] = field(default_factory=list)


def ingest(spark: SparkSession, specs: Mapping[str, SourceSpec], out: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Decode every export to clean text columns and store it; stop on a missing or undecodable one."""
    files = settle(normalise.fingerprints(
        spark, {name: (spec.path, spec.declared) for name, spec in specs.items()}), "fingerprints")
    normalise.require_inputs(files, sorted(specs))
    # decoded once: the tables and the manifest are both made of the stored lines
    lines = settle(normalise.normalised_lines(spark, files), "lines")
    staged = {}
    for name, spec in specs.items():
        parsed = registry.parse_files(lines.filter(F.col("source") == name), spec)
        staged[name] = write_table(parsed, f"{out}/staged/{name.replace(':', '_')}")
    return staged, write_table(normalise.manifest(files, lines), f"{out}/manifest")


def _parts(staged: Mapping[str, DataFrame], name: str) -> DataFrame:
    """All files of one ledger, stacked by column name before anything is counted."""
    stacked = None
    for key in sorted(staged):
        if key.split(":")[0] == name:
            stacked = staged[key] if stacked is None else stacked.unionByName(staged[key])
    if stacked is None:
        raise ValueError(f"missing input: {name}")
    return stacked


def _paypal_raw(staged: Mapping[str, DataFrame]) -> DataFrame:
    return staging.tag_accounts({
        account: _parts(staged, f"{account}_activity") for account in ("paypal_us", "paypal_eu")})


def _window(config: RunConfig) -> tuple[Column, Column]:
    if config.export_window is None:
        raise ValueError("export_window must state the first and last day the exports cover")
    start, end = config.export_window
    return F.lit(start).cast("date"), F.lit(end).cast("date")


def stage(staged: Mapping[str, DataFrame], config: RunConfig) -> dict[str, DataFrame]:
    return {
        "fx_rates": refdata.rate_versions(_parts(staged, "fx_rates")),
        "fee_schedule": refdata.fee_contracts(_parts(staged, "fee_schedule")),
        "ledger": staging.ledger(_parts(staged, "payment_engine_log")),
        "adyen": staging.adyen(_parts(staged, "adyen_payment_accounting")),
        "dlocal": staging.dlocal(_parts(staged, "dlocal_transactions")),
        "google_play": staging.google_play(_parts(staged, "google_play_earnings"), config),
        "paypal": staging.paypal(_paypal_raw(staged), *_window(config))}


@dataclass
class Store:
    """Writes the tables of a run and has their columns checked in the pass that writes them."""

    out: str
    seen: dict[str, Observation] = field(default_factory=dict)

    def write(self, name: str, df: DataFrame, path: str | None = None, partition_by: tuple[str, ...] = ()) -> DataFrame:
        observed, self.seen[name] = quality.observe_columns(name, df)
        return write_table(observed, f"{self.out}/{path or name}", partition_by)


def reconcile_tables(layers: Mapping[str, DataFrame], config: RunConfig, store: Store) -> dict[str, DataFrame]:
    """Staged relations to the classified rows and the report."""
    rates = settle(refdata.current_rates(layers["fx_rates"]), "current_rates")
    calendar = refdata.rate_calendar(rates)
    if calendar.n_days <= config.max_broadcast_rows:
        calendar = replace(calendar, days=settle(calendar.days, "rate_calendar"))
    contracts = refdata.contract_spans(layers["fee_schedule"])

    conformed = staging.conform_union(*[layers[p] for p in ("adyen", "dlocal", "google_play", "paypal")])
    priced = pricing.apply_contracts(pricing.price_providers(conformed, calendar, config), contracts, config)
    providers = store.write("providers", priced)
    restated = pricing.restate_ledger(layers["ledger"], calendar, config)
    restated = store.write("restated", restated)

    names = matching.reported_names(providers)
    reported = (matching.only_reported(restated, providers) if names is None
                else restated.filter(F.col("psp").isin(*names)))
    ours = matching.signed_ledger(reported)
    hot = matching.hot_match_keys(ours, providers, config)
    matched = store.write("matched", matching.match_sides(ours, providers, hot, config.period_unit))

    classified = classify.classify(classify.scope_to_period(matched, config.reporting_month))
    # the rows of one month need no partitions, nor the shuffle that makes them
    by_month = () if config.reporting_month else ("reporting_month",)
    classified = store.write("classified", classified, partition_by=by_month)
    summary = store.write("summary", report.recon_summary(classified), "recon_summary", ("reporting_month",))
    waterfall = store.write("waterfall", report.recon_waterfall(summary), "recon_waterfall", ("reporting_month",))
    return {"providers": providers, "restated": restated, "matched": matched, "classified": classified,
            "summary": summary, "waterfall": waterfall}


def checks(tables: Mapping[str, DataFrame], seen: Mapping[str, Observation]) -> dict[str, DataFrame]:
    """Every check that needs only the run's own tables; an empty frame is a pass."""
    t = tables
    found = {f"columns_{name}": quality.observed_checks(name, t[name], noted) for name, noted in seen.items()}
    found |= {
        "capture_completeness": quality.capture_completeness(t["ledger"]),
        "reference_coverage": quality.reference_coverage(t["ledger"]),
        "booked_usd_reproducible": quality.booked_usd_reproducible(t["ledger"]),
        "rate_grain": quality.rate_grain(t["fx_rates"]),
        "fx_correction_arithmetic": quality.fx_correction_arithmetic(t["restated"]),
        "grain_preserved": quality.grain_preserved(t["ledger"], t["restated"]),
        "timezone_converted": quality.timezone_converted(t["google_play"], t["ledger"]),
        "paypal_fee_is_tariff": quality.paypal_fee_is_tariff(t["paypal"]),
        "reversals_resolve": quality.reversals_resolve(t["paypal"]),
        "net_ties_to_gross_less_fees": quality.net_ties_to_gross_less_fees(t["providers"]),
        "recon_grain": quality.recon_grain(t["matched"]),
        "fixed_fee_currency_handled": quality.fixed_fee_currency_handled(t["classified"]),
        "matched_rows_agree": quality.matched_rows_agree(t["classified"]),
        "matched_fees_agree": quality.matched_fees_agree(t["classified"]),
        "fee_verdict_on_settled_sales": quality.fee_verdict_on_settled_sales(t["classified"]),
        "buckets_reconcile": quality.buckets_reconcile(t["classified"]),
        "waterfall_closes": quality.waterfall_closes(t["classified"]),
        "residual_is_stated": quality.residual_is_stated(t["summary"]),
        "base_covers_scope": quality.base_covers_scope(t["summary"]),
        "subtotals_close": quality.subtotals_close(t["waterfall"]),
        "waterfall_ties_to_source": quality.waterfall_ties_to_source(t["waterfall"], t["classified"])}
    return found


def raw_checks(staged: Mapping[str, DataFrame], layers: Mapping[str, DataFrame], config: RunConfig) -> dict[str, DataFrame]:
    """Checks that recompute from the exports as delivered."""
    adyen, dlocal = _parts(staged, "adyen_payment_accounting"), _parts(staged, "dlocal_transactions")
    paypal = _paypal_raw(staged)
    found = {
        "authorised_not_double_counted": quality.authorised_not_double_counted(adyen, layers["adyen"]),
        "repeated_lines_identical": quality.repeated_lines_are_identical(dlocal),
        "minor_units_scaled": quality.minor_units_scaled(dlocal, layers["dlocal"]),
        "fee_rows_folded": quality.fee_rows_folded(_parts(staged, "google_play_earnings")),
        "declared_zone_is_gmt": quality.declared_zone_is_gmt(paypal),
        "dates_unresolved": quality.dates_unresolved(staging.paypal_typed(paypal, *_window(config)))}
    if config.expected_date_overrides is not None:
        pinned = adyen.sparkSession.createDataFrame(
            [(order,) for order in config.expected_date_overrides], "order_ref string")
        found["date_override_bounded"] = quality.date_override_bounded(layers["paypal"], pinned)
    return found


def violations(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``check`` and how many rows violate it, for every check of a run."""
    counted = None
    for name, df in sorted(frames.items()):
        one = df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
        counted = one if counted is None else counted.unionByName(one)
    return counted


def reconcile(spark: SparkSession, paths: Mapping[str, str], config: RunConfig) -> Run:
    """The whole run. ``paths``: source name -> file or folder (see ``sources.registry``)."""
    have = {name.split(":")[0] for name in paths}
    missing = [name for name in REQUIRED if name not in have]
    if missing:
        raise ValueError(f"missing inputs: {', '.join(missing)}")
    out = (config.output_dir or fresh_path(spark, "run")).rstrip("/")
    staged, manifest = ingest(spark, registry.registry(paths), out)
    # read by the plan and by many checks, so stored
    store = Store(out)
    layers = {name: store.write(name, df, f"layers/{name}") for name, df in stage(staged, config).items()}
    run = Run(tables={**layers, "manifest": manifest, **reconcile_tables(layers, config, store)})
    frames = {**checks(run.tables, store.seen), **raw_checks(staged, layers, config)}
    run.tables |= {f"check_{name}": df for name, df in frames.items()}
    run.tables["violations"] = write_table(violations(frames), f"{out}/violations")
    run.failed = sorted(r["check"] for r in run.tables["violations"].filter("violations > 0").collect())
    if run.failed and config.stop_on_failed_checks:
        raise ValueError(f"failed checks, see {out}/violations: {', '.join(run.failed)}")
    run.tables["waterfall_report"] = write_table(
        report.rendered_waterfall(report.waterfall_pivot_total(run.tables["waterfall"])), f"{out}/waterfall_report")
    for name, order in (("summary", sinks.summary_order()), ("waterfall", sinks.waterfall_order())):
        run.files[name] = sinks.export_csv(
            run.tables[name], f"{out}/exports", f"recon_{name}", order, config.reporting_month)
    return run

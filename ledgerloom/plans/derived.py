"""The derived exports, staged and carried through every layer.

A provider delivers files, so each derived export is stored once per session and data folder, under the
shared folder, and read like any other input. From there every layer is lazy: one plan per result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.config import RunConfig
from ledgerloom.functions import time
from ledgerloom.operators import classify, matching, pricing, refdata, report, staging
from ledgerloom.operators.asof import DailyReference, SparseReference, asof_daily
from ledgerloom.plans import exports
from ledgerloom.plans.dialect import SPARK
from ledgerloom.sources.workspace import fresh_path, write_table

# (application, data folder, label) -> where the derived table lies; and what was measured of the rates
_stored: dict[tuple[str, str, str], tuple[str, StructType]] = {}
_measured: dict[tuple[str, str], DailyReference] = {}
_hot_keys: dict[tuple[str, str], list[tuple]] = {}
EXPORT_DAYS = 32  # days an export reaches past the first of its month


def run_steps(spark: SparkSession, steps: exports.Steps, **views: DataFrame) -> DataFrame:
    """Run named SELECTs in order, each over the given views and the results before it."""
    result = None
    for name, text in steps:
        for view in views:
            text = re.sub(rf"\bFROM {view}\b", f"FROM {{{view}}}", text)
        result = spark.sql(text, **{v: df for v, df in views.items() if f"{{{v}}}" in text})
        views[name] = result
    return result


class Derived:
    """All layers over one data folder. The period unit is the year: the orders span seven of them."""

    def __init__(self, spark: SparkSession, sf_dir: str, config: RunConfig | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.config = config or RunConfig(period_unit="year", google_play_account=exports.GOOGLE_ACCOUNT)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _store(self, label: str, build: Callable[[], DataFrame], spread: bool = True) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, label)
        if key not in _stored:
            df = build()
            # a table of a few files would leave every later scan with a few tasks
            cores = self.spark.sparkContext.defaultParallelism
            if spread and len(self.table("orders").inputFiles()) < cores:
                df = df.repartition(cores)
            path = fresh_path(self.spark, label)
            write_table(df, path)
            _stored[key] = (path, df.schema)
        path, schema = _stored[key]
        return self.spark.read.schema(schema).parquet(path)

    def _derive(self, steps: exports.Steps, **views: DataFrame) -> DataFrame:
        return run_steps(self.spark, steps, **views)

    # reference data

    @property
    def fx_rates_raw(self) -> DataFrame:
        return self._store("fx_rates_raw", lambda: self._derive(exports.fx_rates(SPARK), orders=self.table("orders")))

    @cached_property
    def rate_versions(self) -> DataFrame:
        return refdata.rate_versions(self.fx_rates_raw)

    @property
    def current_rates(self) -> DataFrame:
        return self._store("current_rates", lambda: refdata.current_rates(self.rate_versions), spread=False)

    @property
    def calendar(self) -> DailyReference:
        """The rate of every day, stored: a few thousand rows that many plans look up."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _measured:
            _measured[key] = refdata.rate_calendar(self.current_rates)
        days = self._store("rate_calendar", lambda: _measured[key].days, spread=False)
        return replace(_measured[key], days=days)

    @cached_property
    def contracts_raw(self) -> DataFrame:
        return self.spark.createDataFrame(
            list(exports.CONTRACT_ROWS), ", ".join(f"{c} string" for c in exports.CONTRACT_COLUMNS))

    @cached_property
    def contracts(self) -> SparseReference:
        return refdata.contract_spans(refdata.fee_contracts(self.contracts_raw))

    # raw exports

    @cached_property
    def payments(self) -> DataFrame:
        return self._derive(exports.payments(SPARK), orders=self.table("orders"))

    def _rated(self, df: DataFrame, **times: str) -> DataFrame:
        for name, column in times.items():
            df = asof_daily(df, self.calendar, {"currency": "currency"}, time.day_of(F.col(column)),
                            {"usd_rate": f"{name}_rate", "rate_date": f"{name}_rate_date"}, self.config)
        return df

    @cached_property
    def provider_view(self) -> DataFrame:
        return self._derive(exports.provider_view(SPARK), payments=self.payments)

    @property
    def adyen_raw(self) -> DataFrame:
        return self._store("adyen", lambda: self._derive(exports.adyen(SPARK), provider_view=self.provider_view))

    @property
    def dlocal_raw(self) -> DataFrame:
        return self._store("dlocal", lambda: self._derive(exports.dlocal(SPARK), provider_view=self._rated(
            self.provider_view, captured="captured_at")))

    @property
    def google_play_raw(self) -> DataFrame:
        return self._store("google_play", lambda: self._derive(exports.google_play(SPARK), provider_view=self._rated(
            self.provider_view, captured="captured_at")))

    @property
    def paypal_raw(self) -> DataFrame:
        return self._store("paypal", lambda: self._derive(exports.paypal(SPARK), provider_view=self.provider_view))

    @property
    def payment_log_raw(self) -> DataFrame:
        return self._store("payment_log", self._payment_log)

    def _payment_log(self) -> DataFrame:
        rated = self._rated(self.payments, created="created_at", reversed="reversed_at")
        earlier = asof_daily(
            rated, self.calendar, {"currency": "currency"}, F.date_sub("created_rate_date", 1),
            {"usd_rate": "previous_rate", "rate_date": "previous_date"}, self.config)
        return self._derive(exports.payment_log(SPARK), payments=earlier)

    def prepare(self) -> None:
        """Store every derived export now, so that a later query is timed without them."""
        for name in ("fx_rates_raw", "current_rates", "calendar", "adyen_raw", "dlocal_raw", "google_play_raw", "paypal_raw",
                     "payment_log_raw", "hot_keys"):
            getattr(self, name)

    # staged

    @cached_property
    def ledger(self) -> DataFrame:
        return staging.ledger(self.payment_log_raw)

    @cached_property
    def adyen(self) -> DataFrame:
        return staging.adyen(self.adyen_raw)

    @cached_property
    def dlocal(self) -> DataFrame:
        return staging.dlocal(self.dlocal_raw)

    @cached_property
    def google_play(self) -> DataFrame:
        return staging.google_play(self.google_play_raw.drop("part"), self.config)

    @property
    def window(self):
        start = F.col("export_month").cast("date")
        return start, F.date_add(start, EXPORT_DAYS)

    @cached_property
    def paypal(self) -> DataFrame:
        return staging.paypal(self.paypal_raw, *self.window)

    @cached_property
    def conformed(self) -> DataFrame:
        return staging.conform_union(self.adyen, self.dlocal, self.google_play, self.paypal)

    # priced, matched, classified

    @cached_property
    def restated(self) -> DataFrame:
        return pricing.restate_ledger(self.ledger, self.calendar, self.config)

    @cached_property
    def priced(self) -> DataFrame:
        return pricing.price_providers(self.conformed, self.calendar, self.config)

    @cached_property
    def providers(self) -> DataFrame:
        return pricing.apply_contracts(self.priced, self.contracts, self.config)

    @cached_property
    def signed(self) -> DataFrame:
        return matching.signed_ledger(self.restated)

    @property
    def hot_keys(self) -> list[tuple]:
        """Match keys heavy enough to be joined apart, looked for once on the raw key columns."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _hot_keys:
            ours = self.ledger.select("psp", matching.ledger_match_key().alias("match_key"), "operation_type")
            theirs = staging.export_keys(self.adyen_raw, self.dlocal_raw, self.google_play_raw, self.paypal_raw)
            _hot_keys[key] = matching.hot_match_keys(ours, theirs, self.config)
        return _hot_keys[key]

    @cached_property
    def matched(self) -> DataFrame:
        return matching.match_sides(self.signed, self.providers, self.hot_keys, self.config.period_unit)

    @cached_property
    def scoped(self) -> DataFrame:
        return classify.scope_to_period(self.matched)

    @cached_property
    def classified(self) -> DataFrame:
        return classify.classify(self.scoped)

    @cached_property
    def summary(self) -> DataFrame:
        return report.recon_summary(self.classified)

    @cached_property
    def waterfall(self) -> DataFrame:
        return report.recon_waterfall(self.summary)

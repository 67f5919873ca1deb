"""The shape of the plans, which decides whether they hold at a thousand times the data."""

import os
import re

import pytest

from ledgerloom.plans.derived import Derived
from ledgerloom.plans.checked import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data here")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def derived(spark):
    """With Spark's own broadcasts off, as they are for large tables, only ours remain."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    d = Derived(spark, FOLDER)
    d.prepare()
    yield d
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [
    "dim_lookup_rate", "asof_rate_lateral", "asof_pricing", "contracted_fee", "lifecycle_fold", "fee_row_fold",
    "scope_semi_join", "two_sided_match", "stated_residual", "recon_summary", "waterfall_pivot_total",
    "profile_calendar_holes", "profile_coverage", "dq_date_override_bounded", "dq_minor_units_scaled",
    "dq_reversals_resolve", "dq_timezone_converted", "dq_waterfall_ties_to_source", "dq_fx_join_preserves_grain"])
def test_no_pairs_of_everything(spark, derived, name):
    plan = physical(QUERIES[name].run(spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_only_reference_data_is_broadcast(derived):
    plan = physical(derived.matched)
    # two rate lookups on the ledger, one on the providers, one contract lookup
    assert len(re.findall(r"\+- BroadcastExchange", plan)) <= 4
    # the lifecycle fold; the fee fold and the match need no join
    assert plan.count("SortMergeJoin") == 1 and "FullOuter" not in plan


def test_ledger_is_shuffled_once_before_the_match(derived):
    assert physical(derived.restated).count("Exchange hashpartitioning") == 0
    assert physical(derived.signed).count("Exchange hashpartitioning") == 0


def test_scans_read_only_what_is_asked(derived):
    df = derived.adyen.select("operation_type", "amount_local_settled")
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", physical(df))
    assert scans and all("Batch Number" not in s and "Net Credit" not in s for s in scans)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", physical(df))
    assert any("Record Type" in p for p in pushed), pushed


def test_python_is_out_of_the_hot_path(derived):
    plan = physical(derived.summary)
    assert "Python" not in plan and "Pandas" not in plan
    assert plan.count("HashAggregate") >= 2


def test_summary_reads_the_match_once(derived):
    assert physical(derived.summary).count("Window [lead(__right") == 1

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.config import RunConfig
from ledgerloom.operators import matching
from ledgerloom.operators.asof import asof_daily, asof_effective, daily, effective_dated
from ledgerloom.operators.folding import attach_summary, collapse_copies
from ledgerloom.operators.joins import keyed_join

DAY0 = date(2026, 1, 1)


def reference(seed):
    rng = random.Random(seed)
    return [(c, DAY0 + timedelta(days=d), rng.randint(1, 10**6))
            for c in ("EUR", "GBP", "BRL") for d in sorted(rng.sample(range(5, 60), 12))]


def probes(seed):
    rng = random.Random(seed)
    # USD has no rates and holds most rows; null currencies and dates past the last rate occur
    return [(i, rng.choice(["USD"] * 5 + ["EUR", "GBP", "BRL", None]), DAY0 + timedelta(days=rng.randint(0, 90)))
            for i in range(400)]


def brute_force(rows, refs):
    out = {}
    for i, currency, day in rows:
        found = [(d, v) for c, d, v in refs if c == currency and d <= day]
        out[i] = max(found) if found else (None, None)
    return out


@pytest.mark.parametrize("config", [RunConfig(), RunConfig(max_broadcast_rows=0, asof_salts=5)])
@pytest.mark.parametrize("layout", ["daily", "effective"])
def test_asof_against_brute_force(spark, config, layout):
    refs, rows = reference(1), probes(2)
    right = spark.createDataFrame(refs, "currency string, rate_date date, v int")
    left = spark.createDataFrame(rows, "i int, currency string, day date")
    make, join = (daily, asof_daily) if layout == "daily" else (effective_dated, asof_effective)
    got = join(left, make(right, ["currency"], "rate_date"), {"currency": "currency"}, F.col("day"),
               {"rate_date": "d", "v": "v"}, config)
    assert got.columns == ["i", "currency", "day", "d", "v"]
    assert {r.i: (r.d, r.v) for r in got.collect()} == brute_force(rows, refs)
    assert got.count() == len(rows)


def test_measured_side_decides_the_strategy(spark):
    refs = daily(spark.createDataFrame(reference(1), "currency string, rate_date date, v int"), ["currency"], "rate_date")
    left = spark.createDataFrame(probes(2), "i int, currency string, day date")

    def plan(config):
        df = asof_daily(left, refs, {"currency": "currency"}, F.col("day"), {"v": "v"}, config)
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(RunConfig())
    assert "strategy=broadcast" not in plan(RunConfig(max_broadcast_rows=refs.n_days - 1))


def test_empty_reference_gives_nulls(spark):
    empty = spark.createDataFrame([], "currency string, rate_date date, v int")
    left = spark.createDataFrame([(1, "EUR", DAY0)], "i int, currency string, day date")
    got = asof_daily(left, daily(empty, ["currency"], "rate_date"), {"currency": "currency"}, F.col("day"), {"v": "v"})
    assert [tuple(r) for r in got.collect()] == [(1, "EUR", DAY0, None)]


def test_rows_without_a_key_survive_an_outer_join_and_spread(spark):
    left = spark.createDataFrame([(None, i) for i in range(300)] + [("a", -1)], "k string, l int")
    right = spark.createDataFrame([(None, i) for i in range(200)] + [("a", -2)], "k string, r int")
    joined = keyed_join(left, right, ["k"], "full_outer")
    assert joined.columns == ["k", "l", "r"]
    assert joined.count() == 501
    assert joined.filter("l is not null and r is not null").collect()[0].asDict() == {"k": "a", "l": -1, "r": -2}
    keyless = joined.filter("k is null").withColumn("p", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert keyless.groupBy("p").count().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_attach_summary_never_fans_out(spark):
    rows = spark.createDataFrame([("o1", 1), ("o1", 2), (None, 3)], "k string, v int")
    details = spark.createDataFrame([("o1", 5), ("o1", 7), (None, 9)], "k string, d int")
    got = attach_summary(rows, details, ["k"], d=F.max("d"))
    assert sorted((r.v, r.d) for r in got.select("v", "d").collect() if r.d) == [(1, 7), (2, 7)]
    assert got.count() == 3


def test_collapse_counts_identical_rows_only(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("a", 2), (None, None), (None, None)], "k string, v int")
    assert sorted(map(str, ((r.k, r.v, r.n_copies) for r in collapse_copies(df).collect()))) == sorted(
        map(str, [("a", 1, 3), ("a", 2, 1), (None, None, 2)]))


def sides(spark, hot_ours, hot_theirs):
    ours = ([("p", "HOT", "sale", f"x{i}") for i in range(hot_ours)] + [("p", f"k{i}", "sale", f"t{i}") for i in range(50)]
            + [("p", None, "sale", f"n{i}") for i in range(20)])
    theirs = ([("p", "HOT", "sale", f"y{i}") for i in range(hot_theirs)] + [("p", f"k{i}", "sale", f"q{i}") for i in range(25, 75)]
              + [("p", None, "sale", f"m{i}") for i in range(10)])
    keys = "psp string, match_key string, operation_type string"

    def pad(df, columns):
        money = [c for c in columns if c.startswith(("amount", "fee", "fixed_fee", "percent", "fx_correction", "fx_rate"))]
        for c in columns:
            if c not in df.columns:
                kind = ("timestamp_ntz" if c.endswith("utc") else "int" if c == "batch_number"
                        else "decimal(18,2)" if c in money and c != "fixed_fee_currency" else "string")
                df = df.withColumn(c, F.lit(None).cast(kind))
        return df

    left = pad(spark.createDataFrame(ours, f"{keys}, txn_id string").withColumn("order_id", F.col("match_key")),
               [*matching._LEDGER_COLUMNS, "sku", "country"])
    right = pad(spark.createDataFrame(theirs, f"{keys}, psp_reference string").withColumn("order_ref", F.col("match_key")),
                [*matching._PROVIDER_COLUMNS, *matching._PROVIDER_AS_IS])
    return left, right


@pytest.mark.parametrize("hot_ours, hot_theirs", [(1, 400), (400, 1), (0, 400), (400, 0), (20, 20)])
def test_hot_key_split_changes_nothing_but_the_plan(spark, hot_ours, hot_theirs):
    left, right = sides(spark, hot_ours, hot_theirs)
    hot = matching.hot_match_keys(left, right, fraction=1.0, least_hits=15)
    assert hot == [("p", "HOT", "sale")]

    def rows(h):
        df = matching.match_sides(left, right, h)
        return sorted(map(str, df.select("psp", "match_key", "txn_id", "psp_reference", "in_engine", "in_psp").collect()))

    assert rows(hot) == rows([])


def test_no_hot_key_no_split(spark):
    left, right = sides(spark, 1, 1)
    assert matching.hot_match_keys(left, right, fraction=1.0, least_hits=15) == []


def test_repeated_keys_pair_in_order(spark):
    """Three rows against two of one key give three rows, not six, split apart as hot keys or not."""
    left, right = sides(spark, 3, 2)
    for hot in ([], [("p", "HOT", "sale")]):
        rows = matching.match_sides(left, right, hot).filter("match_key = 'HOT'")
        assert rows.count() == 3 and rows.filter("in_engine and in_psp").count() == 2
        assert rows.agg(F.count_distinct("txn_id"), F.count_distinct("psp_reference")).first() == (3, 2)


def test_pairing_costs_the_sum_of_both_sides(spark):
    """One shuffle and no join: a key's n and m rows are never held against each other."""
    left, right = sides(spark, 30_000, 20_000)
    plan = matching.match_sides(left, right)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Exchange") == 1
    rows = plan.filter("match_key = 'HOT'").agg(F.count("*"), F.count_if(F.col("in_engine") & F.col("in_psp")), F.count_distinct("txn_id")).first()
    assert tuple(rows) == (30_000, 20_000, 30_000)


def test_rows_without_a_day_have_no_rate(spark):
    rates = spark.sql("select 'EUR' as currency, date'2026-05-01' as rate_date, 1.10 as usd_rate "
                      "union all select 'EUR', date'2026-06-30', 2.00")
    rows = spark.sql("select 'EUR' as currency, cast(d as date) as day from values ('2026-05-03'), ('2026-07-09'), (null) t(d)")
    ref = daily(rates, ["currency"], "rate_date")
    got = {str(r.day): r.rate for r in asof_daily(rows, ref, {"currency": "currency"}, F.col("day"),
                                                      {"usd_rate": "rate"}).collect()}
    assert {d: r and str(r) for d, r in got.items()} == {"2026-05-03": "1.10", "2026-07-09": "2.00", "None": None}

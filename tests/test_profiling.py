from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import profiling


@pytest.mark.parametrize("block", [2, 3, 10, 1_000_000])
def test_sequence_gaps_against_brute_force(spark, block):
    present = [-7, -6, 0, 1, 2, 5, 6, 20, 21, 99, 100, 101, 5000, 5000, 4_000_000_000_123]
    numbers = sorted(set(present))
    expected = [(a + 1, b - 1, b - a - 1) for a, b in zip(numbers, numbers[1:]) if b - a > 1]
    df = spark.createDataFrame([(n,) for n in [*present, None]], "n bigint")
    assert sorted(map(tuple, profiling.sequence_gaps(df, "n", block).collect())) == expected


def test_sets_holes_ranges_and_coverage(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x"), ("b", "y"), ("c", "y")], "k string, s string")
    assert sorted(map(tuple, profiling.lifecycle_sets(df, "k", "s").collect())) == [("x+y", 1), ("y", 2)]
    days = spark.createDataFrame([("EUR", date(2026, 6, 18)), ("EUR", date(2026, 6, 22))], "c string, d date")
    assert [tuple(r) for r in profiling.calendar_holes(days, "d", "c").collect()] == [("EUR", date(2026, 6, 19))]
    values = spark.createDataFrame([("EUR", 1.0), ("EUR", 1.024)], "c string, v double").withColumn(
        "v", F.col("v").cast("decimal(18,6)"))
    assert profiling.value_range(values, "c", "v").first().spread_bp == 240
    left, right = df.select("k"), spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    assert tuple(profiling.coverage(left, right, ["k"]).first()) == (1, 2, 1)
    assert tuple(profiling.key_uniqueness(df, ["k"]).first()) == (5, 3, 3)
    rates = profiling.rates_by(df, "k", y=F.col("s") == "y").orderBy("k").first()
    assert (rates.n_rows, rates.n_y, rates.y_bp) == (3, 1, 3333)


def test_columns_are_profiled_in_one_scan(spark):
    df = spark.createDataFrame([("b", 10, None), (" ", 9, None), (None, -1, None)], "text string, `a.b` int, none string")
    got = {r.column_name: tuple(r)[1:] for r in profiling.column_profile(df).collect()}
    assert got == {"text": (3, 1, 1, 1, 1, " ", "b"), "a.b": (3, 0, 0, 1, 2, "-1", "9"), "none": (3, 3, 0, None, None, None, None)}
    assert [tuple(r)[1:3] for r in profiling.column_profile(df.limit(0)).collect()] == [(0, 0)] * 3
    path = "/root/testdata/sf0.001/orders.parquet"
    plan = profiling.column_profile(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1

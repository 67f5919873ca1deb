from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import money, text, time


def one(df):
    return [r[0] for r in df.collect()]


def test_conversion_rounds_half_up_on_the_exact_product(spark):
    df = spark.sql("select cast('254885.56' as decimal(18,2)) a, cast('0.182410' as decimal(18,6)) r "
                   "union all select 0.01, 0.5 union all select -0.01, 0.5")
    assert one(df.select(money.convert(F.col("a"), F.col("r")))) == [
        Decimal("46493.67"), Decimal("0.01"), Decimal("-0.01")]


def test_percent_is_exact_where_binary_floats_are_not(spark):
    df = spark.sql("select cast(0.60 as decimal(18,2)) a, cast(2.5 as decimal(9,4)) p")
    assert one(df.select(money.percent_of(F.col("a"), F.col("p")))) == [Decimal("0.02")]


@pytest.mark.parametrize("minor, exponent, major", [
    ("1990", 2, "19.90"), ("9900", 0, "9900.00"), ("12345", 3, "12.35"), (None, 2, None)])
def test_minor_units(spark, minor, exponent, major):
    df = spark.createDataFrame([(minor, exponent)], "m string, e int")
    got = one(df.select(money.from_minor_units(F.col("m").cast("decimal(24,4)"), F.col("e"))))
    assert got == [major and Decimal(major)]


def test_unknown_exponent_stops_the_run(spark):
    df = spark.createDataFrame([("1", 7)], "m string, e int")
    with pytest.raises(Exception, match="unsupported currency exponent"):
        df.select(money.from_minor_units(F.col("m").cast("decimal(24,4)"), F.col("e"))).collect()


@pytest.mark.parametrize("part, whole, digits, percent", [
    ("200679.44", "205576.14", 2, "97.62"), ("1.00", "3.00", 4, "33.3333"), ("2.00", "3.00", 2, "66.67"),
    ("5.00", "0.00", 2, "0.00"), ("0.00", "5.00", 2, "0.00"), ("5.00", None, 2, "0.00"), ("1.00", "-4.00", 2, "-25.00")])
def test_share(spark, part, whole, digits, percent):
    df = spark.createDataFrame([(part, whole)], "p string, w string").select(
        F.col("p").cast("decimal(38,2)").alias("p"), F.col("w").cast("decimal(38,2)").alias("w"))
    out = f"decimal(12,{digits})"
    assert one(df.select(money.share_percent(F.col("p"), F.col("w"), digits, out))) == [Decimal(percent)]


def test_accounting_notation(spark):
    df = spark.sql("select * from values (1234.5), (-0.01), (0.0) t(x)").select(F.col("x").cast("decimal(18,2)").alias("x"))
    assert one(df.select(money.accounting(F.col("x")))) == ["1,234.50", "(0.01)", "—"]


def test_decimal_comma_and_vocabulary(spark):
    df = spark.createDataFrame([("-1234,56", "PAID"), ("7.10", "OTHER"), (None, None)], "a string, v string")
    rows = df.select(text.money(F.col("a")), text.vocabulary(F.col("v"), {"PAID": "settled"})).collect()
    assert [tuple(r) for r in rows] == [
        (Decimal("-1234.56"), "settled"), (Decimal("7.10"), None), (None, None)]


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_composite_key_in_an_hour_the_session_zone_skips(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        df = spark.sql("select timestamp_ntz'2001-04-01 02:19:24.5' t, 's' s, 'c' c")
        assert one(df.select(text.composite_key(F.col("t"), F.col("s"), F.col("c")))) == ["2001-04-01T02:19:24|s|c"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_composite_key_is_null_as_soon_as_a_part_is(spark):
    df = spark.sql("select timestamp_ntz'2020-01-02 03:04:05' t, 'sku' s, 'DE' c union all select null, 'sku', 'DE'")
    assert one(df.select(text.composite_key(F.col("t"), F.col("s"), F.col("c")))) == ["2020-01-02T03:04:05|sku|DE", None]


@pytest.mark.parametrize("zone, local, utc", [
    ("Europe/Amsterdam", datetime(2026, 7, 1, 2, 0), datetime(2026, 7, 1, 0, 0)),
    ("Europe/Amsterdam", datetime(2026, 1, 1, 0, 30), datetime(2025, 12, 31, 23, 30)),
    # 02:30 happens twice when clocks go back; the second pass is standard time
    ("Europe/Amsterdam", datetime(2025, 10, 26, 2, 30), datetime(2025, 10, 26, 1, 30)),
    # 02:30 does not happen when clocks go forward
    ("Europe/Amsterdam", datetime(2025, 3, 30, 2, 30), datetime(2025, 3, 30, 1, 30)),
    ("America/Los_Angeles", datetime(2026, 6, 30, 17, 0), datetime(2026, 7, 1, 0, 0))])
@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_local_to_utc_whatever_the_session_zone(spark, zone, local, utc, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        df = spark.createDataFrame([(local,)], "t timestamp_ntz")
        assert one(df.select(time.local_to_utc(F.col("t"), zone))) == [utc]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("day, order, expected", [
    ("06/07/2026", "mdy", datetime(2026, 6, 7, 1, 2, 3)), ("06/07/2026", "dmy", datetime(2026, 7, 6, 1, 2, 3)),
    ("6/7/2026", "mdy", datetime(2026, 6, 7, 1, 2, 3)), ("13/01/2026", "mdy", None), ("30/02/2026", "dmy", None),
    ("nonsense", "dmy", None), (None, "dmy", None)])
def test_clock_text(spark, day, order, expected):
    df = spark.createDataFrame([(day, "01:02:03")], "d string, t string")
    parts = time.clock_parts(F.col("d"), F.col("t"))
    assert one(df.select(time.clock_time(parts, order))) == [expected]


def test_worded_date(spark):
    df = spark.createDataFrame([("Jul 1, 2026", "02:40:10")], "d string, t string")
    assert one(df.select(time.worded_date(F.col("d"), F.col("t")))) == [datetime(2026, 7, 1, 2, 40, 10)]

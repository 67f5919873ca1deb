"""Exact decimal arithmetic on money columns. Every product stays within 38 digits before it is
rounded, so results are HALF_UP of the exact value."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.config import MONEY


# Number of minor-unit digits -> size of one minor unit in major units.
MINOR_UNIT = {e: Decimal(1).scaleb(-e) for e in range(5)}


def zero() -> Column:
    return F.lit(Decimal("0.00")).cast(MONEY)


def convert(amount: Column, rate: Column) -> Column:
    """Amount decimal(18,2) at rate decimal(18,6): an exact (37,8) product, rounded to the cent."""
    return F.round(amount * rate, 2).cast(MONEY)


def percent_of(amount: Column, percent: Column) -> Column:
    return F.round(amount * percent * F.lit(Decimal("0.01")), 2).cast(MONEY)


def from_minor_units(minor: Column, exponent: Column) -> Column:
    """Minor units to major units by the row's own exponent; an unknown exponent fails the run."""
    scaled = F.when(exponent.isNull() | minor.isNull(), F.lit(None).cast(MONEY))
    for digits, unit in MINOR_UNIT.items():
        # digits + 2 decimal places hold the exact product before the one rounding to cents
        scaled = scaled.when(exponent == digits, F.round(minor * F.lit(unit), 2).cast(MONEY))
    bad = F.raise_error(F.concat(F.lit("unsupported currency exponent: "), exponent.cast("string")))
    return scaled.otherwise(bad.cast(MONEY))


def or_zero(amount: Column) -> Column:
    return F.coalesce(amount, zero())


def _whole(amount: Column, digits: int) -> Column:
    return (amount * F.lit(10**digits)).cast("decimal(38,0)")


def share_percent(part: Column, whole: Column, digits: int, out: str) -> Column:
    """100 * part / whole at ``digits`` decimals, HALF_UP away from zero, 0 where whole is 0 or null.

    Worked in whole cents with integer division, so it equals the exact quotient's rounding.
    """
    num = _whole(F.abs(part), 2) * F.lit(2 * 100 * 10**digits) + F.abs(_whole(whole, 2))
    den = F.abs(_whole(whole, 2)) * F.lit(2)
    quotient = F.floor(F.try_divide(num.cast("decimal(38,0)"), F.nullif(den.cast("decimal(38,0)"), F.lit(0))))
    signed = quotient * F.signum(part).cast("int") * F.signum(whole).cast("int")
    return F.coalesce((signed.cast("decimal(28,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(out),
                      F.lit(0).cast(out))


def accounting(amount: Column) -> Column:
    """Accounting notation: (1,234.50) for negatives, an em dash for nil."""
    shown = F.format_number(F.abs(amount), 2)
    return (F.when(F.abs(amount) < F.lit(Decimal("0.005")), F.lit("—"))
            .when(amount < 0, F.concat(F.lit("("), shown, F.lit(")")))
            .otherwise(shown))

"""Numeric expressions.

Money columns are DOUBLE, but floating point sums depend on the order in which partial
sums meet, which differs from run to run on a cluster. Sums and means are therefore
taken over integers: every DOUBLE is cut, without error, into its whole units and three
digits of 24 bits of its fraction. The BIGINT sums of these are put together at the end, and
only that is rounded, once, so a sum is the DOUBLE nearest to the true sum, on whatever
partitioning. Bits below 2^-72 are cut off; values of 2^-19 or more have none. Sums of
BIGINTs are several times as fast as those of DECIMALs, and fail rather than wrap: a digit
has room for 2^39 rows of a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGIT_BITS, DIGITS = 24, 3
_DIGIT = 1 << DIGIT_BITS
# Up to here whole units and all digits fit one DECIMAL of 38 places.
_EXACT = 1 << 53


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def exact_parts(value: Column | str) -> list[Column]:
    """Whole units and the digits of the fraction, all towards zero, as BIGINT. NaN and infinity fail."""
    rest = _column(value).cast("double")
    parts = [rest.cast("bigint")]
    for _ in range(DIGITS):
        rest = (rest - parts[-1]) * float(_DIGIT)  # both steps without rounding
        parts.append(rest.cast("bigint"))
    return parts


def exact_total(sums: Sequence[Column | str]) -> Column:
    """The DOUBLE nearest to the sum, from the sums of the parts; NULL if these are."""
    whole, first, second, third = (_column(part) for part in sums)

    def scaled(part: Column, bits: int) -> Column:
        return part.cast("decimal(19,0)") * F.lit(Decimal(1 << bits))

    units = whole.cast("decimal(20,0)") * F.lit(Decimal(1 << DIGIT_BITS * DIGITS))
    near = units + scaled(first, 2 * DIGIT_BITS) + scaled(second, DIGIT_BITS) + third.cast("decimal(19,0)")
    # Beyond 2^53 units the last digits only say whether there is anything above the others.
    carried = second + F.shiftright(third, DIGIT_BITS)
    left = third.bitwiseAND(F.lit(_DIGIT - 1)).bitwiseOR(carried.bitwiseAND(F.lit(_DIGIT - 1)))
    far = (whole.cast("decimal(30,0)") * F.lit(Decimal(2 * _DIGIT))
           + (first + F.shiftright(carried, DIGIT_BITS)).cast("decimal(20,0)") * 2
           + F.when(left > 0, 1).otherwise(0).cast("decimal(1,0)"))
    return F.when(whole.between(F.lit(-_EXACT), F.lit(_EXACT)), near.cast("double") / float(1 << DIGIT_BITS * DIGITS)).otherwise(
        far.cast("double") / float(2 * _DIGIT))


def exact_sum(value: Column | str, wide: bool = False) -> Column:
    """Sum as DOUBLE, rounded once; 0 for a group without any value.

    Sums up to 9e18 fit; a larger one fails. With `wide` they may have eleven digits more,
    which is meant for totals repeated on many rows.
    """
    whole, *digits = exact_parts(value)
    if wide:
        whole = whole.cast("decimal(20,0)")
    return F.coalesce(exact_total([F.sum(whole), *map(F.sum, digits)]), F.lit(0.0))


def exact_mean(value: Column | str) -> Column:
    """Mean of the present values; NULL for a group without any."""
    return F.try_divide(exact_total([F.sum(part) for part in exact_parts(value)]), F.count(_column(value)))


def percent(part: Column | str, whole: Column | str) -> Column:
    return F.try_divide(_column(part).cast("double"), _column(whole).cast("double")) * 100


def null_if_nan(value: Column | str) -> Column:
    value = _column(value)
    return F.when(~F.isnan(value), value)

"""Exact money arithmetic and divisions that give NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_units(amount: Column, scale: int | None) -> Column:
    """Money as whole units of its last decimal (cents for scale 2); unchanged without a scale.

    A 64-bit sum of units is exact, needs no decimal objects and raises on overflow.
    """
    if scale is None:
        return amount
    return F.rint(amount * F.lit(float(10**scale))).cast("bigint")


def finite_units(amount: Column, scale: int | None) -> Column:
    """``to_units`` with NULL for NaN and the infinities, which have no units."""
    if scale is None:
        return amount
    return F.when(~non_finite(amount), to_units(amount, scale))


def from_units(units: Column, scale: int | None) -> Column:
    """Back to a double: the one nearest to the exact value."""
    if scale is None:
        return units
    return units / F.lit(float(10**scale))


def sum_states(amount: Column, scale: int | None) -> dict[str, Column]:
    """What to keep of a group to know its sum: units, and NaN and infinities beside them."""
    units = {"_sum": F.sum(finite_units(amount, scale))}
    return units if scale is None else units | {"_special": F.sum(F.when(non_finite(amount), amount))}


def sum_of_states(scale: int | None) -> Column:
    """The sum from these states; a NaN or an infinity decides."""
    total = from_units(F.col("_sum"), scale)
    return total if scale is None else F.coalesce("_special", total)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in double; NULL where the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def non_finite(value: Column) -> Column:
    """True for NaN and the infinities."""
    return F.isnan(value) | F.abs(value).eqNullSafe(F.lit(float("inf")))


def double_order(value: Column) -> Column:
    """A 64-bit number that orders as Spark orders doubles: -0.0 like 0.0, NaN last.

    It is the bits of the double without its sign, negated below 0. No built-in gives them,
    but dividing by a power of two is exact, so exponent and mantissa are; the logarithm only
    guesses the exponent, and may be one off next to a power of two.
    """
    value = value.cast("double")
    size = F.abs(value)

    def power(exponent: Column) -> Column:
        return F.pow(F.lit(2.0), exponent.cast("double"))

    guess = F.least(F.floor(F.log2(size)), F.lit(1023).cast("bigint"))
    exact = guess + F.when(size < power(guess), -1).when(size >= power(guess + 1), 1).otherwise(0)
    exponent = F.greatest(exact, F.lit(-1022).cast("bigint"))
    bits = (exponent + 1022) * F.lit(2**52) + (size / power(exponent) * F.lit(float(2**52))).cast("bigint")
    ordinary = F.when(size == 0, F.lit(0).cast("bigint")).otherwise(F.when(value < 0, -bits).otherwise(bits))
    endless = F.lit(2047 * 2**52)
    return (
        F.when(F.isnan(value), endless + 1)
        .when(size == float("inf"), F.when(value < 0, -endless).otherwise(endless))
        .otherwise(ordinary)
    )

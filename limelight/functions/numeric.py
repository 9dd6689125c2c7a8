"""Rounding and number formatting as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SPLIT = 134217729.0  # 2**27 + 1, halves a double's significand
_WHOLE = 4503599627370496.0  # 2**52: doubles from here on are whole numbers


def exact_round(x: Column, digits: int) -> Column:
    """Round the exact binary value of a double, ties to even.

    Spark's ``round`` works on the shortest decimal text, so it lifts 2.675 to 2.68; the
    double is below that tie and Python rounds it to 2.67. The product ``x * 10**digits``
    is split into its rounded value and its exact error, and the error decides ties. From
    a product of 2**52 on a double has nothing left to round and is returned as it is.
    """
    if digits == 0:
        return F.rint(x)
    scale = F.lit(float(10**digits))
    x = x.cast("double")
    wide = x * F.lit(_SPLIT)
    high = wide - (wide - x)
    product = x * scale
    error = (high * scale - product) + (x - high) * scale
    whole = F.floor(product).cast("double")
    past_half = product - whole - F.lit(0.5)
    odd = F.abs(whole % 2) == 1
    up = (past_half > 0) | (
        (past_half == 0) & ((error > 0) | ((error == 0) & odd))
    )
    rounded = (whole + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / scale
    return F.when(F.abs(product) >= F.lit(_WHOLE), x).otherwise(rounded)


def array_round(x: Column, digits: int) -> Column:
    """Round the way array libraries do: scale, round half to even, scale back."""
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


def grouped(n: Column) -> Column:
    """Integer with thousands separators, NULL shown as 0."""
    return F.format_string("%,d", F.coalesce(n.cast("bigint"), F.lit(0)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL on a zero or NULL divisor."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))

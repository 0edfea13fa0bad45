"""Rounding of doubles by their exact binary value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.cleaning import bound


def round_exact(c: Column, digits: int) -> Column:
    """Round a double to `digits` decimals by the value it really has.

    `round` works on the shortest decimal that reads back as the double, so it takes 0.725 for a
    tie although the double lies below it. Here the double is split into a whole number and a
    power of two, and the division is done in whole numbers; a true tie goes to the even digit.
    """
    one = F.lit(1).cast("bigint")
    ten = F.lit(10**digits).cast("decimal(17,0)")

    def scaled(x: Column) -> Column:
        shift = (53 - F.floor(F.log2(F.abs(x)))).cast("int")
        low, high = F.least(F.greatest(shift, F.lit(0)), F.lit(62)), F.greatest(shift - 62, F.lit(0))
        whole = (F.abs(x) * F.pow(F.lit(2.0), low) * F.pow(F.lit(2.0), high)).cast("bigint")  # exact
        power = lambda n: F.call_function("shiftleft", one, n).cast("decimal(19,0)")
        parts = F.struct((whole.cast("decimal(20,0)") * ten).alias("n"), (power(low) * power(high)).alias("d"))
        return bound(parts, lambda p: bound(p.withField("rest", p["n"] % p["d"]), lambda p: rounded(x, p)))

    def rounded(x: Column, p: Column) -> Column:
        down = ((p["n"] - p["rest"]) / p["d"]).cast("bigint")
        up = (p["rest"] * 2 > p["d"]) | ((p["rest"] * 2 == p["d"]) & (down % 2 == 1))
        return F.signum(x) * (down + F.when(up, 1).otherwise(0)).cast("double") / float(10**digits)

    # beyond 2^50 a double has no decimals worth rounding; below 2^-45 nothing is left
    size = F.abs(c)
    return (F.when(c.isNull() | F.isnan(c) | (size >= 2.0**50), c).when(size < 2.0**-45, F.lit(0.0))
            .otherwise(bound(c, scaled)))

"""One decimal as Python's `:.1f` writes it: by the exact binary value, halves to the even neighbour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tenths(x: Column) -> Column:
    """The whole number of tenths nearest to x (a double from 0 to 2^48), halves to even.

    Java's formatter rounds the shortest decimal that names the double, half up. Here 20 x stands as an exact sum of two doubles (x split into
    26 bits and the rest, after Veltkamp), so that its distance from an odd number has the right sign.
    """
    wide = x * F.lit(134217729.0)
    high = wide - (wide - x)
    low = x - high
    down = F.floor(x * 10)
    past_half = (high * 20 - (down * 2 + 1).cast("double")) + low * 20
    return down + F.when((past_half > 0) | ((past_half == 0) & (down % 2 == 1)), 1).otherwise(0)


def one_decimal(x: Column) -> Column:
    """Text of a double as f"{x:.1f}" gives it, for magnitudes up to 2^48; nan and inf as Python writes them. Null gives null."""
    digits = tenths(F.abs(x)).cast("string")
    digits = F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits)
    sign = F.when((x < 0) | (x.cast("string") == "-0.0"), "-").otherwise("")
    text = F.regexp_replace(F.concat(sign, digits), "(.)$", ".$1")
    return F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf").otherwise(text)

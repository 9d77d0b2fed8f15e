"""Scores to four decimals, by either of two rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from namebridge.config import MatchConfig

DIGITS = 4
# 20,000 = 32 * 625: twice the scale as a power of two, which is exact in a double, times an odd factor.
_POWER, _FACTOR = 32.0, 625.0
#: 2**27 + 1 splits a double into two halves of at most 26 bits.
_SPLIT = 134217729.0


def half_even(value: Column) -> Column:
    """The double nearest to the value rounded to four decimals as Python's ``round`` does.

    The exact binary value decides, not its shortest decimal form, and an exact tie goes to the even digit. Rounding half
    up on the decimal form can only be wrong by one step downwards, at a tie of that form. Whether the binary value
    lies below the tie is the sign of 20,000 value - (2 n - 1), which both halves of the value give without error.
    Null, NaN and infinities stay; magnitudes are to be below 10**11.
    """
    size = F.abs(value)
    n = F.round(F.round(size, DIGITS) * F.lit(10.0**DIGITS))
    high = size * F.lit(_SPLIT) - (size * F.lit(_SPLIT) - size)
    above = (high * F.lit(_FACTOR) - (n * 2 - 1) / F.lit(_POWER)) + (size - high) * F.lit(_FACTOR)
    down = (n > 0) & ((above < 0) | ((above == 0) & (n % 2 == 1)))
    rounded = F.when(down, n - 1).otherwise(n) / F.lit(10.0**DIGITS)
    plain = F.isnan(value) | (size == F.lit(float("inf")))
    return F.when(plain, value).otherwise(F.when(value < 0, -rounded).otherwise(rounded))


def rounded(value: Column, config: MatchConfig) -> Column:
    """A score by the rule that the configuration names."""
    return half_even(value) if config.rounding == "half_even" else F.round(value, DIGITS)

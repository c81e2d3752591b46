"""Rounding as Python's ``round(x, digits)``: the exact binary value decides, and only a true tie goes to even.

``x * 10^digits`` is split without error into ``p + e`` (the nearest double and its error, by splitting ``x`` into
halves whose products with the power of ten are exact), so a value next to a tie falls on its own side.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def py_round(c: str | Column, digits: int) -> Column:
    """``round(c, digits)`` of a double, 0 <= digits <= 6; null, NaN and infinities stay as they are."""
    if not 0 <= digits <= 6:
        raise ValueError("digits: 0 to 6")
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    power = F.lit(float(10 ** digits))
    t = x * F.lit(134217729.0)  # 2^27 + 1: the upper 26 bits of x
    hi = t - (t - x)
    a, b = hi * power, (x - hi) * power  # both exact
    p = a + b
    e = (a - p) + b  # p + e = x * power, exactly
    k = F.floor(p).cast("double")
    above = (p - k) - F.lit(0.5)  # exact; an error e only counts at a tie of p
    even = F.pmod(k, F.lit(2.0)) == 0
    up = (above > 0) | ((above == 0) & ((e > 0) | ((e == 0) & ~even)))
    rounded = F.when(up, k + 1).otherwise(k) / power
    # beyond, doubles are integers in units of the last digit, or x isn't a number
    return F.when(F.abs(x) < F.lit(2.0 ** 51) / power, F.when((rounded == 0) & (x < 0), F.lit(-0.0)).otherwise(rounded)).when(F.isnan(x), x).otherwise(F.round(x, digits) if digits else F.rint(x))

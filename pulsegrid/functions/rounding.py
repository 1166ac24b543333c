"""Half-even rounding of a double on its exact binary value (Python ``round``).

``bround`` rounds the shortest decimal text of the double (2.675 → 2.68),
and ``rint(x * 100) / 100`` fails when the product ``x * 100`` itself rounds
onto a .5 tie (2.675 * 100 → 267.5). Here the rounding error of the product
is recovered exactly (Veltkamp split: ``x = hi + lo`` with 26-bit halves,
so ``hi * s`` and ``lo * s`` are exact) and decides such ties, which gives
the correctly rounded result. Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1


def round_half_even(x: Column, digits: int = 2) -> Column:
    s = float(10**digits)
    p = x * s
    c = x * _SPLIT
    hi = c - (c - x)
    lo = x - hi
    err = (hi * s - p) + lo * s  # sign of (exact x*s) - p
    fl = F.floor(p).cast("double")
    tie = (p - fl) == 0.5
    y = F.when(tie & (err < 0), fl).when(tie & (err > 0), fl + 1).otherwise(F.rint(p))
    return y / s

"""Rounding of doubles by their exact binary value, ties to even.

``F.round`` rounds the decimal text of a double half up: 2.675 becomes 2.68 though
the double lies below that tie, and 0.125 becomes 0.13.  Here 2.675 becomes 2.67
and 0.125, an exact tie, 0.12.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = float(2 ** 27 + 1)
_LIMIT = float(2 ** 44)      # below, twice the scaled value is exact in whole numbers


def round_binary(col: Column, scale: int = 2) -> Column:
    """``col`` rounded to ``scale`` (0 to 4) places.

    The value is split in two halves of 26 bits, whose products with 2 * 10^scale
    are exact; their sum is compared with the odd number halfway between the two
    candidates.  From 2^44 up, infinite and not-a-number values stay as they are.
    """
    if not 0 <= scale <= 4:
        raise ValueError("scale must be from 0 to 4")
    x, ten = col.cast("double"), float(10 ** scale)

    def rounded(v: Column) -> Column:
        size = F.abs(v)
        big = size * _SPLIT
        high = big - (big - size)
        low = size - high
        down = F.floor(size * ten).cast("double")
        # sign of (exact value - halfway); both products and their difference are exact
        over = (high * (2 * ten) - (down * 2 + 1)) + low * (2 * ten)
        up = (over > 0) | ((over == 0) & (F.pmod(down, F.lit(2.0)) == 1))
        out = F.when(up, down + 1).otherwise(down) / ten
        return F.when(size < _LIMIT / ten, F.when(v < 0, -out).otherwise(out)).otherwise(v)
    return F.get(F.transform(F.array(x), rounded), F.lit(0))

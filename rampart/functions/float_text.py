"""Doubles as text: the shortest decimal that reads back as the same double.

Spark writes ``1.0E7`` where the sort key of an unordered compare needs
``10000000.0``: no exponent from 1e-4 up to 1e16, a two-digit exponent beyond.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _shortest(x: Column) -> Column:
    """Spark's own text, or 16 or 17 digits where it gave more and they read back
    the same (some Java versions write a digit or two too many)."""
    plain = x.cast("string")
    digits = F.length(F.regexp_replace(F.split_part(plain, F.lit("E"), F.lit(1)), "[^0-9]", ""))
    out = plain
    for places in (16, 15):
        less = F.format_string(f"%.{places}e", x)
        out = F.when((digits > places + 1) & (less.cast("double") == x), less).otherwise(out)
    return out


def _cut(text: Column) -> Column:
    """Without closing zeros, but one digit after the point."""
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", ".0")


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _written(x: Column, short: Column) -> Column:
    size = F.abs(x)
    plain = _cut(short.cast("decimal(38,22)").cast("string"))
    mantissa = F.regexp_replace(F.regexp_extract(short, r"^(-?[0-9.]+)[eE]", 1), r"\.?0+$", "")
    power = F.regexp_extract(short, r"[eE]\+?(-?\d+)$", 1).cast("int")
    far = F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"),
                   F.regexp_replace(F.abs(power).cast("string"), r"^(\d)$", "0$1"))
    return (F.when(F.isnan(x), "nan").when(size == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
            .when(size == 0, F.when(short.startswith("-"), "-0.0").otherwise("0.0"))
            .when((size >= 1e-4) & (size < 1e16), plain).otherwise(far))


def float_text(col: Column) -> Column:
    """Text of a double: ``1.0``, ``0.0001``, ``10000000.0``, ``1e+16``, ``1.5e-05``,
    ``inf``, ``-inf``, ``nan``; null stays null.

    The middle range goes through an exact decimal of 16 + 22 places, which holds
    every shortest text there is between 1e-4 and 1e16.
    """
    return _bound(col.cast("double"), lambda x: F.when(x.isNotNull(), _bound(_shortest(x), lambda t: _written(x, t))))

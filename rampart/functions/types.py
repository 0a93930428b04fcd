"""Type categories used by the type-preservation policy.

A column is ``string`` (text/binary), ``integral``, ``numeric`` (fractional)
or ``other``.  Decided from the schema alone, so no job runs.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INTEGRAL, NUMERIC, OTHER = "string", "integral", "numeric", "other"


def category(dt: T.DataType) -> str:
    if isinstance(dt, (T.StringType, T.BinaryType, T.CharType, T.VarcharType)):
        return STRING
    if isinstance(dt, T.IntegralType):
        return INTEGRAL
    if isinstance(dt, T.FractionalType):
        return NUMERIC
    return OTHER


def base_type_name(dt: T.DataType) -> str:
    """'decimal(18,6)' -> 'DECIMAL'; 'bigint' -> 'BIGINT'."""
    return dt.simpleString().split("(")[0].strip().upper()


def drifted_to_string(expected: T.DataType, found: T.DataType) -> bool:
    """Only numeric-to-string drift is a violation; other drift is allowed."""
    return category(expected) in (INTEGRAL, NUMERIC) and category(found) == STRING

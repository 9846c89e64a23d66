"""Common types of two columns that hold the same values without loss.

Only pairs that Spark's Parquet reader also widens while it reads: files of the
narrower type need no rewrite when a table's column becomes wider.
"""

from __future__ import annotations

from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Decimal digits that an integer of each type can hold, narrowest type first.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of ``a`` and of ``b``; None if
    there is none (long and double, text and numbers, ...)."""
    if a == b:
        return a
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    floating = (T.FloatType, T.DoubleType)
    if isinstance(a, floating) and isinstance(b, floating):
        return T.DoubleType()
    for x, y in ((a, b), (b, a)):
        if isinstance(x, _WHOLE) and isinstance(y, floating):
            return None if isinstance(x, T.LongType) else T.DoubleType()
        if isinstance(x, _WHOLE) and isinstance(y, T.DecimalType):
            return wider_type(T.DecimalType(_DIGITS[type(x)], 0), y)
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None

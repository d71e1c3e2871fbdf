"""Exact means and rounding for decimal measures, and the same operators for doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_decimal(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.DecimalType)


def mean_of(total: Column, count: Column, dtype: T.DataType) -> Column:
    """``total / count``, NULL when nothing was counted; decimals keep 16 fractional digits."""
    count = F.nullif(count, F.lit(0))
    if is_decimal(dtype):
        return total.cast("decimal(28,6)") / count.cast("decimal(18,0)")
    return total / count


def round_half_up(value: Column, digits: int, dtype: T.DataType) -> Column:
    """Decimals end as 18-digit ones, which Spark keeps in a single long."""
    if is_decimal(dtype):
        return F.round(value, digits).cast(f"decimal(18,{digits})")
    scale = float(10**digits)
    return F.floor(value * scale + F.lit(0.5)) / F.lit(scale)

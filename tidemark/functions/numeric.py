"""Guarded arithmetic."""

from pyspark.sql import Column, functions as F


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as a double, and 0.0 where ``bottom`` is zero or null."""
    return F.when(bottom != 0, top.cast("double") / bottom).otherwise(F.lit(0.0))


def percent(top: Column, bottom: Column) -> Column:
    return F.when(bottom != 0, top.cast("double") / bottom * 100).otherwise(F.lit(0.0))


def or_zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0))


def whole(x: Column) -> Column:
    """A number as a 64-bit integer; beyond the range the nearest one."""
    top = F.lit(2**63 - 1).cast("long")
    low = F.lit(-(2**63)).cast("long")
    return F.when(x >= 2.0**63, top).when(x <= -(2.0**63), low).otherwise(x.try_cast("long"))

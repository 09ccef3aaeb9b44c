"""Guarded arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_div(top: Column, bottom: Column) -> Column:
    """Ratio that is null where the divisor is zero (ANSI mode raises otherwise)."""
    return top / F.nullif(bottom, F.lit(0))


def clip(value: Column, low: float, high: float) -> Column:
    """Bound a value to [low, high], keeping null as null."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def finite(value: Column) -> Column:
    """NaN and infinities become null, the only missing value used past the sources."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def row_mean(*values: Column) -> Column:
    """Mean of several columns in one row, skipping nulls."""
    zero = F.lit(0.0)
    total = sum((F.coalesce(v, zero) for v in values), zero)
    present = sum((v.isNotNull().cast("int") for v in values), F.lit(0))
    return total / F.nullif(present, F.lit(0))


def rounded(df, *names: str, digits: int = 6):
    """Round the named double columns, so that sums in another order compare equal."""
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})

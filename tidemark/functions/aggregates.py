"""Aggregate expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalars import holds

_LOW_BITS = 20


def total(c: Column, scale: int | None = None) -> Column:
    """Sum as double, 0 for all-NULL input.

    With ``scale`` the values are fixed-point numbers with that many decimals (money) and the sum is
    exact, hence the same for every partitioning. It adds whole units in two BIGINT halves, which stays
    in generated code and cannot overflow at any realistic row count; casting each double to DECIMAL
    first costs about ten times as much.
    """
    if scale is None:
        return F.coalesce(F.sum(c), F.lit(0)).cast("double")
    units = F.floor(c * F.lit(float(10**scale)) + F.lit(0.5))
    high = F.coalesce(F.sum(F.shiftright(units, _LOW_BITS)), F.lit(0))
    low = F.coalesce(F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("bigint"))), F.lit(0))
    whole = high.cast("decimal(20,0)") * F.lit(1 << _LOW_BITS).cast("decimal(7,0)") + low.cast("decimal(20,0)")
    return whole.cast("double") / F.lit(float(10**scale))


def count_where(predicate: Column) -> Column:
    return F.count_if(holds(predicate))


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """100 * part / whole, NULL for an empty whole."""
    value = F.try_divide(part.cast("double"), whole.cast("double")) * 100
    return value if digits is None else F.round(value, digits)

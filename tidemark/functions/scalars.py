"""Row-level numeric and boolean expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """NaN becomes NULL, so that one notion of "missing" reaches comparisons and aggregates."""
    return F.when(~F.isnan(c), c)


def holds(predicate: Column) -> Column:
    """Two-valued reading of a predicate: unknown counts as false."""
    return F.coalesce(predicate, F.lit(False))


def log_amount(c: Column) -> Column:
    return F.log1p(c)


def hour_of_elapsed(seconds: Column) -> Column:
    """Hour of day (0-23) of a running second counter."""
    return F.pmod(F.floor(seconds / 3600), F.lit(24)).cast("int")


def clip(c: Column, low: float, high: float) -> Column:
    """Bound a value; NULL stays NULL (``greatest``/``least`` alone would turn it into a bound)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def safe_ratio(numerator: Column, denominator: Column, scale: float = 100.0) -> Column:
    """``numerator / denominator * scale``; x/0 gives 0 and 0/0 stays missing."""
    num, den = numerator.cast("double"), denominator.cast("double")
    return F.when(den == 0, F.when(num != 0, F.lit(0.0))).otherwise(F.try_divide(num, den) * scale)


def relative_gap(stated: Column, computed: Column) -> Column:
    """|stated - computed| / stated; a stated zero with a non-zero computed value is an infinite gap."""
    gap = F.abs(stated - computed)
    return F.when(stated == 0, F.when(computed != 0, F.lit(float("inf")))).otherwise(F.try_divide(gap, stated))


def bin_label(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins whose first bin includes its lower edge; outside the edges is NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    chain = F.when(c < edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        chain = chain.when(c <= upper, F.lit(label))
    return chain


def on_time_flag(
    status: Column, good: str = "advance|on time", bad: str = "late|canceled"
) -> Column:
    """1 when a delivery status reads as punctual, 0 otherwise (a missing status counts as 0)."""
    text = F.lower(F.coalesce(status, F.lit("")))
    return (text.rlike(good) & ~text.rlike(bad)).cast("int")


def show_count(c: Column) -> Column:
    """Text with thousands separators, for reports."""
    return F.format_number(c, 0)


def show_percent(c: Column, digits: int = 2) -> Column:
    """Text such as ``12.50%``, for reports."""
    return F.format_string(f"%.{digits}f%%", c.cast("double"))


def delay_days(actual: Column, scheduled: Column) -> Column:
    """Days later than scheduled; negative means early."""
    return actual - scheduled

"""Calendar parts and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(ts: Column) -> Column:
    """First day of the month as a date: the chronological key of a monthly series."""
    return F.trunc(ts.cast("date"), "month")


def month_key(ts: Column) -> Column:
    """Sortable text month, e.g. ``2017-04``."""
    return F.date_format(ts, "yyyy-MM")


def month_label(ts: Column) -> Column:
    """Display month, e.g. ``Apr-2017`` (sorts alphabetically, not in time)."""
    return F.date_format(ts, "MMM-yyyy")


def month_name(number: Column) -> Column:
    return F.monthname(F.make_date(F.lit(2000), number.cast("int"), F.lit(1)))


def quarter_label(ts: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(ts).cast("string"))


def duration_minutes(start: Column, end: Column) -> Column:
    """Fractional minutes between two timestamps, exact to the microsecond.

    Zone-less timestamps are compared as they stand, whatever the session time zone.
    """
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(60_000_000.0)

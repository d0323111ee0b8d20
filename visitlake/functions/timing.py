"""Time expressions on visit columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def micros(ts: Column) -> Column:
    """Microseconds since 1970; the session zone is UTC (see ``session.prepare``)."""
    return F.unix_micros(ts.cast("timestamp"))


def elapsed(start: Column, end: Column) -> Column:
    """Signed microseconds between two times, NULL when either is missing."""
    return micros(end) - micros(start)


def sunday_first(ts: Column) -> Column:
    """Day of week counted from Sunday = 0."""
    return F.dayofweek(ts) - 1


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def month_number(ts: Column) -> Column:
    """Months since year 0: one number per calendar month, years kept apart."""
    return F.year(ts) * 12 + F.month(ts)


def bit(position: Column) -> Column:
    """A BIGINT with one bit set; OR-ing bits counts distinct small numbers exactly."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), position)

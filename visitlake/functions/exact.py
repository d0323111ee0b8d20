"""Exact rounding.

Rates, hours and scores are ratios of whole numbers. They are rounded to two
decimals, half away from zero, without ever passing through a binary fraction:
the result is carried as a BIGINT number of hundredths, compared and weighted
as such, and turned into a DOUBLE or a text only in the final projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = "decimal(38,0)"
SECOND_US = 1_000_000
HOUR_US = 3_600_000_000
MINUTE_US = 60_000_000


def whole(x: Column | int) -> Column:
    """A whole number wide enough that products of counts do not overflow."""
    return (x if isinstance(x, Column) else F.lit(x)).cast(WHOLE)


def div(a: Column, b: Column | int) -> Column:
    """Integer quotient, truncated."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def exact_sum(micros: Column) -> Column:
    """Sum of microseconds, exact however many there are.

    A BIGINT total could overflow on a very busy key, and a decimal one is slow to
    build row by row, so whole seconds and the rest are added up apart.
    """
    return whole(F.sum(div(micros, SECOND_US))) * SECOND_US + whole(F.sum(micros % SECOND_US))


def hundredths(p: Column | int, q: Column | int) -> Column:
    """``round(p / q, 2) * 100`` as BIGINT; NULL when q is 0 or anything is NULL.

    q must not be negative.
    """
    p, q = whole(p), whole(q)
    size = div(F.abs(p) * 200 + q, F.nullif(q, F.lit(0).cast(WHOLE)) * 2)
    return F.when(p < 0, -size).otherwise(size)


def percent(part: Column, base: Column) -> Column:
    """Percentage of ``base``, in hundredths."""
    return hundredths(whole(part) * 100, base)


def hours(micros: Column, count: Column | int = 1) -> Column:
    """Hours held in ``micros / count``, in hundredths."""
    return hundredths(micros, whole(count) * HOUR_US)


def minutes(micros: Column) -> Column:
    """Minutes held in ``micros``, in hundredths."""
    return hundredths(micros, MINUTE_US)


def h(value: float) -> int:
    """A plain value with at most two decimals, as hundredths."""
    return round(value * 100)


def weighted(*terms: tuple[Column, float]) -> Column:
    """Sum of two-decimal values (in hundredths) times one-decimal weights, in thousandths."""
    total = None
    for column, weight in terms:
        term = column * round(weight * 10)
        total = term if total is None else total + term
    return total


def thousandths_to_hundredths(x: Column) -> Column:
    """Round a non-negative score kept in thousandths to two decimals."""
    return div(x + 5, 10)


def above(x: Column, floor: int) -> Column:
    """How far x lies above ``floor``, 0 when below it or unknown."""
    return F.greatest(F.lit(0).cast("bigint"), x - floor)


def number(h: Column) -> Column:
    """Hundredths as the DOUBLE nearest to the two-decimal value."""
    return h.cast("double") / F.lit(100.0)


def text2(h: Column) -> Column:
    """Hundredths as text with two decimals, e.g. ``33.30``."""
    return (h.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)").cast("string")


def text1(h: Column) -> Column:
    """A two-decimal value rounded once more to one decimal, as text."""
    tenths = div(h + 5, 10)
    return (tenths.cast("decimal(18,0)") * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(18,1)").cast("string")


def text0(h: Column) -> Column:
    """A two-decimal value rounded once more to a whole number, as text."""
    return div(h + 50, 100).cast("string")


def round_double(x: Column) -> Column:
    """Two decimals of a statistic that is irrational by nature (deviation, score).

    The small addend makes a value meant as a tie round up although its binary
    form lies a hair below it.
    """
    return F.floor(x * 100 + F.lit(0.5 + 1e-9)).cast("double") / F.lit(100.0)

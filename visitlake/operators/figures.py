"""Figures of a report per caregiver, in parts that can be added to one another.

A part covers any share of the visits: one row per caregiver and calendar month, with
counts, sums, least and greatest values, and the days seen as the set bits of one
BIGINT. Parts of several shares, put together, give the same figures as all visits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.functions.timing import bit, month_number

#: A name, the aggregate over rows, and the aggregate over partial columns of that name.
Measures = dict[str, tuple[Column, Column]]


@dataclass(frozen=True)
class Figures:
    """``rows`` are made of visits and reduced by ``measures``.

    ``date`` is the day of a row, whose distinct values are counted as ``days`` and whose
    months as ``months``. Expressions are built on use because they need a session.
    """

    name: str
    rows: Callable[[DataFrame], DataFrame]
    measures: Callable[[], Measures]
    date: Callable[[], Column] | None = None
    days: str | None = None
    months: str | None = None

    def _keys(self) -> list[str]:
        return ["caregiverId", "month"] if self.date else ["caregiverId"]

    def parts(self, visits: DataFrame) -> DataFrame:
        """The part of some visits. A caregiver with a very large share of all is a few hundred rows of it."""
        rows, first = self.rows(visits), [aggregate.alias(name) for name, (aggregate, _) in self.measures().items()]
        if self.date is None:
            return rows.groupBy("caregiverId").agg(*first)
        month, days = month_number(self.date()).alias("month"), F.bit_or(bit(F.dayofmonth(self.date()))).alias("day_bits")
        return rows.groupBy("caregiverId", month).agg(*first, days)

    def added(self, parts: DataFrame) -> DataFrame:
        """Parts of several shares as one: again a row per caregiver and month."""
        days = [F.bit_or("day_bits").alias("day_bits")] if self.date else []
        return parts.groupBy(*self._keys()).agg(*[then.alias(name) for name, (_, then) in self.measures().items()], *days)

    def per_caregiver(self, whole: DataFrame) -> DataFrame:
        """One row per caregiver, from a part that has a row per caregiver and month."""
        if self.date is None:
            return whole
        distinct = [F.coalesce(F.sum(F.bit_count("day_bits")), F.lit(0)).cast("bigint").alias(self.days)]
        if self.months:
            distinct.append(F.count("month").alias(self.months))
        return whole.groupBy("caregiverId").agg(*[then.alias(name) for name, (_, then) in self.measures().items()], *distinct)

    def of(self, visits: DataFrame) -> DataFrame:
        """The figures of all visits, computed from them."""
        return self.per_caregiver(self.parts(visits))

    def of_parts(self, parts: DataFrame) -> DataFrame:
        """The same from the parts of several shares of the visits."""
        return self.per_caregiver(self.added(parts))

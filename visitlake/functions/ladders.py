"""Rule ladders: the first rung whose condition holds gives the value."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(rungs: Iterable[tuple[Column, object]], default: object) -> Column:
    """An unknown (NULL) condition does not match."""
    chain = None
    for condition, value in rungs:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def at_least(x: Column, cuts: Iterable[tuple[int, object]], default: object, scale: int = 100) -> Column:
    """Ladder on descending lower bounds of a column kept in 1/scale units."""
    return ladder([(x >= cut * scale, value) for cut, value in cuts], default)

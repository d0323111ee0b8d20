"""Exact interpolated quantiles of whole numbers by narrowing.

A quantile needs one or two order statistics per group. Rows are first counted
per bucket of values, which collapses map-side to at most (range / width) counts
per group whatever the number of rows; running totals over those counts name
the buckets that hold the wanted ranks. Only rows of these buckets are then
counted value by value. No group is ever gathered or sorted as rows.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.functions.exact import div


def _ranks(p: Fraction, total: Column) -> tuple[Column, Column, Column]:
    """Zero-based lower and upper rank of quantile p among ``total`` values, and the numerator of the rest."""
    steps = (total - 1) * p.numerator
    lower, rest = div(steps, p.denominator), steps % p.denominator
    return lower, lower + (rest > 0).cast("bigint"), rest


def bucket_of(value: Column, width: int) -> Column:
    return div(value - F.pmod(value, F.lit(width)), width)


def targets(counts: DataFrame, keys: list[str], probabilities: dict[str, Fraction], count: str = "rows") -> DataFrame:
    """``counts`` (keys, bucket, number of values in it) with ``before``, ``total`` and whether a bucket is ``wanted``.

    Windows over counts: bounded by the number of buckets per group. Other columns stay.
    """
    group = Window.partitionBy(*keys)
    running = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumns({
        "before": F.coalesce(F.sum(count).over(running), F.lit(0)), "total": F.sum(count).over(group),
    })
    wanted = F.lit(False)
    for p in probabilities.values():
        lower, upper, _ = _ranks(p, F.col("total"))
        wanted = wanted | ((lower < F.col("before") + F.col(count)) & (upper >= F.col("before")))
    return placed.withColumn("wanted", wanted & (F.col(count) > 0))


def picked(per_value: DataFrame, keys: list[str], probabilities: dict[str, Fraction], keep: tuple[str, ...] = ()) -> DataFrame:
    """The quantiles, from the counts (rows) of the values in the wanted buckets, with their ``before`` and ``total``.

    ``keep`` are columns with one value per group.
    """
    within = Window.partitionBy(*keys, "bucket").orderBy("value")
    last = F.col("before") + F.sum("rows").over(within.rowsBetween(Window.unboundedPreceding, 0)) - 1
    ranked = per_value.withColumn("last", last).withColumn("first", F.col("last") - F.col("rows") + 1)
    picks = []
    for name, p in probabilities.items():
        lower, upper, _ = _ranks(p, F.col("total"))
        for rank, end in ((lower, "low"), (upper, "high")):
            held = (F.col("first") <= rank) & (rank <= F.col("last"))
            picks.append(F.max(F.when(held, F.col("value"))).alias(f"{name}_{end}"))
    chosen = ranked.groupBy(*keys).agg(F.max("total").alias("total"), *picks, *[F.first(c).alias(c) for c in keep])
    result = []
    for name, p in probabilities.items():
        _, _, rest = _ranks(p, F.col("total"))
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        result += [low, high, (low + (high - low) * rest / F.lit(float(p.denominator))).alias(name)]
    return chosen.select(*keys, *keep, *result)


def bucketed(rows: DataFrame, keys: list[str], value: str, width: int) -> DataFrame:
    """``keys``, ``value`` and its ``bucket``; NULL values are left out."""
    return rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("value"), bucket_of(F.col(value), width).alias("bucket"))


def spread(mean: str, moment: str, count: str, total_mean: Column) -> Column:
    """Sum over parts of their squared deviations from a common mean, from each part's own mean and variance."""
    own = F.coalesce(F.col(moment) * F.col(count), F.lit(0.0))
    apart = F.coalesce((F.col(mean) - total_mean) * (F.col(mean) - total_mean) * F.col(count), F.lit(0.0))
    return F.sum(own + apart)


def exact_quantiles(
    rows: DataFrame,
    keys: list[str],
    value: str,
    probabilities: dict[str, Fraction],
    width: int,
    small: bool = False,
) -> DataFrame:
    """One row per group of ``keys`` with ``<name>_low``, ``<name>_high`` and ``<name>``.

    ``<name>`` interpolates linearly between the two neighbouring order statistics
    (as PERCENTILE_CONT does); ``_low`` and ``_high`` are those, for callers that
    go on in whole numbers. NULL values are left out. ``small`` states that the
    number of groups is bounded, so that the wanted buckets (at most two per group
    and probability) may be broadcast.
    """
    values = bucketed(rows, keys, value, width)
    counts = values.groupBy(*keys, "bucket").agg(F.count("*").alias("rows"))
    hit = targets(counts, keys, probabilities).where("wanted").select(*keys, "bucket", "before", "total")
    place = [*keys, "bucket"]
    if small:
        per_value = values.join(F.broadcast(hit), place).groupBy(*place, "before", "total", "value").agg(F.count("*").alias("rows"))
    else:
        # counted before the join, so that one very common value is one row in it
        per_value = values.groupBy(*place, "value").agg(F.count("*").alias("rows")).join(hit, place)
    return picked(per_value, keys, probabilities)

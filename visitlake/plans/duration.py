"""Visit duration: valid and defective durations, their spread and classes."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.functions.exact import HOUR_US, MINUTE_US, exact_sum, hours, hundredths, number, percent, round_double
from visitlake.operators.facts import count, duration_flags
from visitlake.operators.quantile import bucket_of, bucketed, picked, spread, targets
from visitlake.plans.common import CAREGIVER_LIMIT, numbers, with_caregiver

MEDIAN = {"median": Fraction(1, 2)}


KINDS = [
    "NO_ACTUAL_TIMES", "MISSING_CLOCK_IN", "MISSING_CLOCK_OUT",
    "INVALID_DURATION", "EXCESSIVE_DURATION", "TOO_SHORT_DURATION",
]


def _valid() -> Column:
    return F.col("data_quality_flag") == "VALID_DURATION"


def _counted() -> dict[str, Column]:
    flag, us = F.col("data_quality_flag"), F.when(_valid(), F.col("actual_us"))
    return {
        "total_visits": F.count("*"),
        "valid_duration_visits": count(_valid()),
        **{kind.lower(): count(flag == kind) for kind in KINDS},
        "valid_us": exact_sum(us),
        "planned_us": exact_sum(F.col("scheduled_us")),
        "planned_visits": F.count("scheduled_us"),
        "difference_us": exact_sum(F.col("difference_us")),
        "compared_visits": F.count("difference_us"),
        # a visit of exactly 4 hours counts in both middle classes
        "visits_under_1_hour": count(us < HOUR_US),
        "visits_1_to_4_hours": count(us.between(HOUR_US, 4 * HOUR_US)),
        "visits_4_to_8_hours": count(us.between(4 * HOUR_US, 8 * HOUR_US)),
        "visits_over_8_hours": count(us > 8 * HOUR_US),
    }


def minute_parts(visits: DataFrame) -> DataFrame:
    """Figures per caregiver and minute of duration, which add up over shares of the visits."""
    us = F.when(_valid(), F.col("actual_us"))
    minute = bucket_of(us, MINUTE_US).alias("bucket")
    return duration_flags(visits).select("*", minute).groupBy("caregiverId", "bucket").agg(
        *[measure.alias(name) for name, measure in _counted().items()],
        F.min(us).alias("min_us"), F.max(us).alias("max_us"), F.avg(us).alias("mean"), F.var_pop(us).alias("variance"),
    )


def minutes_added(parts: DataFrame) -> DataFrame:
    """Parts of several shares of the visits as one.

    Means and variances are put together as moments about the minute, whose size is
    small enough for a double to hold them exactly to far below the digits reported.
    """
    n, start = F.col("valid_duration_visits"), F.col("bucket") * MINUTE_US
    off = F.col("mean") - start
    moments = parts.select("*", (off * n).alias("first"), ((F.col("variance") + off * off) * n).alias("second"))
    mean = F.sum("first") / F.nullif(F.sum("valid_duration_visits"), F.lit(0))
    square = F.sum("second") / F.nullif(F.sum("valid_duration_visits"), F.lit(0))
    return moments.groupBy("caregiverId", "bucket").agg(
        *[F.sum(name).alias(name) for name in _counted()],
        F.min("min_us").alias("min_us"), F.max("max_us").alias("max_us"),
        (mean + F.first(start)).alias("mean"), F.greatest(F.lit(0.0), square - mean * mean).alias("variance"),
    )


def value_parts(visits: DataFrame) -> DataFrame:
    """How often a caregiver's visits last each time, to the microsecond."""
    valid = duration_flags(visits).where(_valid()).select("caregiverId", "actual_us")
    values = bucketed(valid, ["caregiverId"], "actual_us", MINUTE_US)
    return values.groupBy("caregiverId", "bucket", "value").agg(F.count("*").alias("rows"))


def values_added(parts: DataFrame) -> DataFrame:
    return parts.groupBy("caregiverId", "bucket", "value").agg(F.sum("rows").alias("rows"))


def visit_duration(caregivers: DataFrame, visits: DataFrame, limit: int | None = CAREGIVER_LIMIT) -> DataFrame:
    """Durations per caregiver.

    The visits are read once into figures per caregiver and minute, which give all
    measures and the minutes that hold the median, and once, two columns wide, for the
    values of those minutes of the caregivers shown.
    """
    return visit_duration_of(caregivers, minute_parts(visits), value_parts(visits), limit)


def visit_duration_of(
    caregivers: DataFrame, per_minute: DataFrame, per_value: DataFrame, limit: int | None = CAREGIVER_LIMIT
) -> DataFrame:
    """The report on figures per caregiver and minute and counts per value."""
    counted = _counted()
    own = Window.partitionBy("caregiverId")
    placed = targets(per_minute, ["caregiverId"], MEDIAN, "valid_duration_visits")
    placed = placed.withColumn("whole", F.sum("valid_us").over(own) / F.nullif(F.col("total"), F.lit(0)))
    many = F.sum("valid_duration_visits")
    stats = placed.groupBy("caregiverId").agg(
        *[F.sum(name).alias(name) for name in counted],
        F.min("min_us").alias("min_us"), F.max("max_us").alias("max_us"),
        F.when(many > 1, F.sqrt(spread("mean", "variance", "valid_duration_visits", F.col("whole")) / F.nullif(many - 1, F.lit(0)))).alias("deviation_us"),
        # the one or two minutes that hold the median
        F.collect_list(F.when(F.col("wanted"), F.struct("bucket", "before", "total"))).alias("median_minutes"),
    )
    n = F.col("total_visits")
    kept = stats.where(n >= 3).withColumns(
        {
            "problematic_visits": n - F.col("valid_duration_visits"),
            "avg_actual_duration_hours_h": hours(F.col("valid_us"), F.col("valid_duration_visits")),
            "avg_scheduled_duration_hours_h": hours(F.col("planned_us"), F.col("planned_visits")),
            "avg_duration_difference_hours_h": hours(F.col("difference_us"), F.col("compared_visits")),
            "data_quality_percentage_h": percent(F.col("valid_duration_visits"), n),
            "min_actual_duration_hours_h": hours(F.col("min_us")),
            "max_actual_duration_hours_h": hours(F.col("max_us")),
        }
    )
    order = [
        F.col("avg_actual_duration_hours_h").desc_nulls_last(),
        F.col("data_quality_percentage_h").desc_nulls_first(),
        F.col("caregiverId").asc(),
    ]
    named = with_caregiver(kept, caregivers)
    # neither the order nor the filter needs the median, so it is computed for the rows shown
    shown = named.orderBy(*order)
    if limit is not None:
        shown = shown.limit(limit)
    # The figures travel with the one or two minutes of each caregiver: a second branch
    # that needs fewer of them would be computed from the visits anew.
    figures = [c for c in shown.columns if c not in ("caregiverId", "median_minutes")]
    hit = shown.select("caregiverId", F.struct(*figures).alias("figures"), F.explode_outer("median_minutes").alias("hit"))
    hit = hit.select("caregiverId", "figures", "hit.*")
    # values are counted before the join, so that one very common value is one row in it
    medians = picked(hit.join(per_value, ["caregiverId", "bucket"], "left"), ["caregiverId"], MEDIAN, ("figures",))
    median_h = hundredths(F.col("median_low") + F.col("median_high"), 2 * HOUR_US)
    result = medians.select("caregiverId", "figures.*", "median_low", "median_high").orderBy(*order)
    if limit is not None:
        result = result.limit(limit)
    return result.select(
        "caregiverId", "caregiver_name", "total_visits", "valid_duration_visits", "problematic_visits",
        *[kind.lower() for kind in KINDS],
        *numbers(
            "avg_actual_duration_hours", "avg_scheduled_duration_hours", "avg_duration_difference_hours",
            "data_quality_percentage", "min_actual_duration_hours", "max_actual_duration_hours",
        ),
        number(median_h).alias("median_actual_duration_hours"),
        round_double(F.col("deviation_us") / F.lit(float(HOUR_US))).alias("stddev_actual_duration_hours"),
        "visits_under_1_hour", "visits_1_to_4_hours", "visits_4_to_8_hours", "visits_over_8_hours",
    )

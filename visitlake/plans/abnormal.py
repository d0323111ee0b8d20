"""Abnormal visits: durations far from the rest, judged by range, quartiles and deviation."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlake.functions.exact import MINUTE_US, exact_sum, hours, minutes, number, round_double
from visitlake.functions.ladders import ladder
from visitlake.operators.facts import visit
from visitlake.operators.quantile import bucketed, picked, targets
from visitlake.plans.common import VISIT_LIMIT, identity

# Minutes outside this range are abnormal by themselves.
SHORTEST, LONGEST = 15, 1440
QUARTILES = {"q1": Fraction(1, 4), "q3": Fraction(3, 4)}


def duration_stats(visits: DataFrame) -> DataFrame:
    """One row over all visits of plausible length: mean, deviation and quartiles in microseconds.

    The visits are read twice: once into counts, means and variances per minute, of
    which there are at most LONGEST, and once for the values of the few minutes that
    hold the quartiles.
    """
    plausible = visits.where(visit.worked & visit.actual_us.between(SHORTEST * MINUTE_US, LONGEST * MINUTE_US)).select(
        visit.actual_us.alias("actual_us")
    )
    values = bucketed(plausible, [], "actual_us", MINUTE_US)
    per_minute = values.groupBy("bucket").agg(
        F.count("*").alias("rows"), F.avg("value").alias("mean"), F.var_pop("value").alias("variance"), exact_sum(F.col("value")).alias("sum_us")
    )
    placed = targets(per_minute, [], QUARTILES)
    everywhere = Window.partitionBy()
    placed = placed.withColumn("mean_us", F.sum("sum_us").over(everywhere) / F.col("total"))
    own = F.col("variance") * F.col("rows") + (F.col("mean") - F.col("mean_us")) * (F.col("mean") - F.col("mean_us")) * F.col("rows")
    deviation = F.when(F.col("total") > 1, F.sqrt(F.sum(own).over(everywhere) / F.nullif(F.col("total") - 1, F.lit(0))))
    hit = placed.withColumn("deviation_us", deviation).where("wanted").select("bucket", "before", "total", "mean_us", "deviation_us")
    # at most two minutes per quartile, which carry the figures of the whole along
    kept = ["mean_us", "deviation_us"]
    near = values.join(F.broadcast(hit), "bucket")
    per_value = near.groupBy("bucket", "before", "total", "value", *kept).agg(F.count("*").alias("rows"))
    quartiles = picked(per_value, [], QUARTILES, tuple(kept))
    return quartiles.select(*kept, F.col("q1").alias("q1_us"), F.col("q3").alias("q3_us"))


def abnormal_visits(caregivers: DataFrame, visits: DataFrame, limit: int | None = VISIT_LIMIT) -> DataFrame:
    us = F.col("actual_us")
    spread = F.col("q3_us") - F.col("q1_us")
    reach = F.col("deviation_us") * 2
    low_fence, high_fence = F.col("q1_us") - spread * 1.5, F.col("q3_us") + spread * 1.5
    # Kinds with their severities and texts, strongest first.
    kinds = [
        (us < SHORTEST * MINUTE_US, "EXTREMELY_SHORT", "CRITICAL", "Extremely short visit (less than 15 minutes)"),
        (us > LONGEST * MINUTE_US, "EXTREMELY_LONG", "CRITICAL", "Extremely long visit (more than 24 hours)"),
        (us < low_fence, "STATISTICALLY_SHORT", "HIGH", "Statistically short visit (below Q1 - 1.5*IQR)"),
        (us > high_fence, "STATISTICALLY_LONG", "HIGH", "Statistically long visit (above Q3 + 1.5*IQR)"),
        (
            us < F.col("mean_us") - reach, "SIGNIFICANTLY_SHORT", "MEDIUM",
            "Significantly short visit (more than 2 standard deviations below mean)",
        ),
        (
            us > F.col("mean_us") + reach, "SIGNIFICANTLY_LONG", "MEDIUM",
            "Significantly long visit (more than 2 standard deviations above mean)",
        ),
    ]
    both_planned = visit.plan_start.isNotNull() & visit.plan_end.isNotNull()
    rows = visits.where(visit.worked).select(
        "caregiverId", "carelogId",
        visit.plan_start.alias("scheduled_start"), visit.plan_end.alias("scheduled_end"),
        visit.clock_in.alias("actual_start"), visit.clock_out.alias("actual_end"),
        visit.actual_us.alias("actual_us"),
        F.when(both_planned, visit.scheduled_us).alias("scheduled_us"),
    )
    z = F.when(F.col("deviation_us") > 0, F.abs(us - F.col("mean_us")) / F.col("deviation_us"))
    # duration_stats is one row by construction
    judged = (
        rows.crossJoin(F.broadcast(duration_stats(visits)))
        .withColumn("atypical_type", ladder([(c, kind) for c, kind, _, _ in kinds], "NORMAL"))
        .where(F.col("atypical_type") != "NORMAL")
        .withColumns(
            {
                "severity_level": ladder([(F.col("atypical_type") == k, s) for _, k, s, _ in kinds], "LOW"),
                "z_score": round_double(z),
                "actual_duration_minutes_h": minutes(us),
            }
        )
    )
    # Severity sorts as text, descending: MEDIUM, HIGH, CRITICAL.
    order = [
        F.col("severity_level").desc_nulls_first(),
        F.col("z_score").desc_nulls_first(),
        F.col("actual_duration_minutes_h").desc_nulls_first(),
        F.col("carelogId").asc(),
    ]
    people = caregivers.select(*identity()).drop("status")
    # Visits of unknown caregivers go before the cut. Every task then keeps its own top
    # rows, so that a caregiver with very many visits needs no group of its own, and the
    # names are joined to what is left.
    known = judged.join(caregivers.select("caregiverId"), "caregiverId", "left_semi").orderBy(*order)
    if limit is not None:
        known = known.limit(limit)
    result = known.join(people, "caregiverId").orderBy(*order)
    return result.select(
        "caregiverId", "caregiver_name", "email", "phoneNumber", "carelogId",
        "scheduled_start", "scheduled_end", "actual_start", "actual_end",
        number(F.col("actual_duration_minutes_h")).alias("actual_duration_minutes"),
        number(hours(us)).alias("actual_duration_hours"),
        number(minutes(F.col("scheduled_us"))).alias("scheduled_duration_minutes"),
        number(minutes(us - F.col("scheduled_us"))).alias("duration_difference_minutes"),
        "atypical_type", "severity_level", "z_score",
        ladder([(F.col("atypical_type") == k, text) for _, k, _, text in kinds], "Normal duration").alias(
            "atypical_description"
        ),
    )

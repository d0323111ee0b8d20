"""Top performance: attended visits, hours worked, punctuality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.functions.exact import exact_sum, hours, percent
from visitlake.operators.facts import added, count, largest, smallest, visit
from visitlake.operators.figures import Figures, Measures
from visitlake.plans.common import CAREGIVER_LIMIT, numbers, top, with_caregiver


def _measures() -> Measures:
    punctual = (visit.clock_in <= visit.plan_start) & (visit.clock_out >= visit.plan_end)
    return (
        added(
            total_scheduled_visits=F.count("*"),
            actual_visits=count(visit.any_clock),
            complete_visits=count(visit.both_clocks),
            partial_visits=count(visit.any_clock & ~visit.both_clocks),
            no_show_visits=count(visit.no_clock),
            # a clock-out before the clock-in counts negative, as reported
            worked_us=exact_sum(visit.actual_us),
            punctual_visits=count(punctual),
        )
        | smallest(first_actual_visit=visit.clock_in)
        | largest(last_actual_visit=visit.clock_out)
    )


FIGURES = Figures("top_performance", lambda visits: visits, _measures, lambda: visit.clock_in, days="actual_active_days")


def top_performance(caregivers: DataFrame, visits: DataFrame, limit: int | None = CAREGIVER_LIMIT) -> DataFrame:
    return top_performance_of(caregivers, FIGURES.of(visits), limit)


def top_performance_of(caregivers: DataFrame, stats: DataFrame, limit: int | None = CAREGIVER_LIMIT) -> DataFrame:
    """The report on figures per caregiver."""
    n, total = F.col("total_scheduled_visits"), F.coalesce("worked_us", F.lit(0))
    scored = stats.where(n >= 3).withColumns(
        {
            "completion_rate_h": percent(F.col("actual_visits"), n),
            "complete_visit_rate_h": percent(F.col("complete_visits"), n),
            "total_work_hours_h": hours(total),
            "avg_work_hours_h": hours(F.col("worked_us"), F.col("complete_visits")),
            "avg_hours_per_day_h": hours(total, F.col("actual_active_days")),
        }
    )
    order = ["actual_visits", "complete_visits", "total_work_hours_h"]
    return top(with_caregiver(scored, caregivers, "caregiver_status"), order, limit).select(
        "caregiverId", "caregiver_name", "email", "phoneNumber", "caregiver_status",
        "total_scheduled_visits", "actual_visits", "complete_visits", "partial_visits", "no_show_visits",
        *numbers("completion_rate", "complete_visit_rate", "total_work_hours", "avg_work_hours"),
        "punctual_visits", "first_actual_visit", "last_actual_visit", "actual_active_days",
        *numbers("avg_hours_per_day"),
    )

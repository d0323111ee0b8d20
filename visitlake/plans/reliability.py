"""Reliability: absence, late arrival, early departure, completion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.functions.exact import hundredths, percent, whole
from visitlake.functions.ladders import ladder
from visitlake.operators.facts import added, count, largest, visit
from visitlake.operators.figures import Figures, Measures
from visitlake.plans.common import CAREGIVER_LIMIT, numbers, top, with_caregiver


def _measures() -> Measures:
    return (
        added(
            total_scheduled_visits=F.count("*"),
            completed_visits=count(visit.any_clock),
            missed_visits_count=count(visit.missed),
            late_arrivals_count=count(visit.late),
            arrivals=count(visit.plan_start.isNotNull() & visit.clock_in.isNotNull()),
            early_departures_count=count(visit.early),
            departures=count(visit.plan_end.isNotNull() & visit.clock_out.isNotNull()),
        )
        | largest(
            last_missed_visit=F.when(visit.missed, visit.plan_start),
            last_late_arrival=F.when(visit.late, visit.clock_in),
            last_early_departure=F.when(visit.early, visit.clock_out),
        )
    )


FIGURES = Figures("reliability", lambda visits: visits, _measures)


def reliability(caregivers: DataFrame, visits: DataFrame, limit: int | None = CAREGIVER_LIMIT) -> DataFrame:
    return reliability_of(caregivers, FIGURES.of(visits), limit)


def reliability_of(caregivers: DataFrame, stats: DataFrame, limit: int | None = CAREGIVER_LIMIT) -> DataFrame:
    """The report on figures per caregiver."""
    n, done, missed = F.col("total_scheduled_visits"), F.col("completed_visits"), F.col("missed_visits_count")
    late, arrivals = F.col("late_arrivals_count"), F.col("arrivals")
    early, departures = F.col("early_departures_count"), F.col("departures")

    # Rates are compared before rounding, hence as products of counts. A rate with
    # an empty base is unknown and never exceeds anything; 0 > 0 says the same.
    def exceeds(part, base, percentage):
        return part * 100 > base * percentage

    low_completion = done * 100 < n * 70
    kept = stats.where(
        (n >= 5)
        & (exceeds(missed, n, 5) | exceeds(late, arrivals, 20) | exceeds(early, departures, 20) | low_completion)
    )
    # Minimum visits, weights, rungs and labels of the report.
    # 0.5 * absence + 0.3 * lateness + 0.2 * earliness over one common denominator
    a, b, c = whole(n), whole(arrivals), whole(departures)
    score = hundredths(
        whole(missed) * 50 * b * c + whole(late) * 30 * a * c + whole(early) * 20 * a * b, a * b * c
    )
    scored = kept.withColumns(
        {
            "absenteeism_rate_h": percent(missed, n),
            "late_arrival_rate_h": percent(late, arrivals),
            "early_departure_rate_h": percent(early, departures),
            "completion_rate_h": percent(done, n),
            "severity_score_h": score,
            "severity_level": ladder(
                [(exceeds(missed, n, 20), "CRITICAL"), (exceeds(missed, n, 10), "HIGH"), (exceeds(missed, n, 5), "MEDIUM")],
                "LOW",
            ),
            "primary_issue_type": ladder(
                [
                    (exceeds(missed, n, 15), "HIGH_ABSENTEEISM"),
                    (exceeds(late, arrivals, 30), "FREQUENT_LATE_ARRIVALS"),
                    (exceeds(early, departures, 30), "FREQUENT_EARLY_DEPARTURES"),
                    (low_completion, "LOW_COMPLETION_RATE"),
                ],
                "MIXED_ISSUES",
            ),
        }
    )
    order = ["severity_score_h", "absenteeism_rate_h", "late_arrival_rate_h", "early_departure_rate_h"]
    return top(with_caregiver(scored, caregivers, "caregiver_status"), order, limit).select(
        "caregiverId", "caregiver_name", "email", "phoneNumber", "caregiver_status",
        "total_scheduled_visits", "completed_visits", "missed_visits_count",
        "late_arrivals_count", "early_departures_count",
        *numbers(
            "absenteeism_rate", "late_arrival_rate", "early_departure_rate", "completion_rate", "severity_score"
        ),
        "severity_level", "primary_issue_type",
        "last_missed_visit", "last_late_arrival", "last_early_departure",
    )

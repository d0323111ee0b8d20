"""Overtime: who regularly works longer than planned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.functions.exact import (
    HOUR_US, above, exact_sum, h, hours, hundredths, percent, text1, text2, thousandths_to_hundredths, weighted, whole,
)
from visitlake.functions.ladders import at_least, ladder
from visitlake.functions.timing import bit
from visitlake.operators.facts import added, count, largest, overtime_rows, smallest
from visitlake.operators.figures import Figures, Measures
from visitlake.plans.common import CAREGIVER_LIMIT, VISIT_LIMIT, numbers, top, with_caregiver


def _overtime_measures() -> Measures:
    extra, pct = F.col("overtime_us"), F.col("overtime_percentage_h")
    return (
        added(
            total_visits=F.count("*"),
            overtime_visits=count(extra > 0),
            on_time_visits=count(extra == 0),
            severe=count(extra > 2 * HOUR_US),
            extreme=count(extra > 4 * HOUR_US),
            overtime_us=exact_sum(extra),
            percentage_sum=exact_sum(F.when(pct > 0, pct)),
            percentage_visits=count(pct > 0),
        )
        | smallest(first_visit_date=F.col("visit_date"))
        | largest(last_visit_date=F.col("visit_date"), max_overtime_us=extra)
    )


def _overtime_rates() -> dict[str, Column]:
    n = F.col("total_visits")
    return {
        "avg_overtime_hours_h": hours(F.col("overtime_us"), F.col("overtime_visits")),
        "max_overtime_hours_h": hours(F.col("max_overtime_us")),
        "total_overtime_hours_h": hours(F.col("overtime_us")),
        "avg_overtime_percentage_h": hundredths(F.col("percentage_sum"), whole(F.col("percentage_visits")) * 100),
        "frequency_h": percent(F.col("overtime_visits"), n),
        "severe_overtime_frequency_h": percent(F.col("severe"), n),
        "extreme_overtime_frequency_h": percent(F.col("extreme"), n),
    }


def _report_measures() -> Measures:
    return (
        _overtime_measures()
        | added(scheduled_us=exact_sum(F.col("scheduled_us")), actual_us=exact_sum(F.col("actual_us")))
        | largest(
            max_overtime_percentage_h=F.col("overtime_percentage_h"),
            last_overtime_date=F.when(F.col("overtime_us") > 0, F.col("visit_date")),
        )
    )


OVERTIME = Figures(
    "overtime", overtime_rows, _report_measures, lambda: F.col("visit_date"), days="active_days", months="active_months"
)


def overtime(caregivers: DataFrame, visits: DataFrame, limit: int | None = CAREGIVER_LIMIT) -> DataFrame:
    return overtime_of(caregivers, OVERTIME.of(visits), limit)


def overtime_of(caregivers: DataFrame, stats: DataFrame, limit: int | None = CAREGIVER_LIMIT) -> DataFrame:
    """The report on figures per caregiver."""
    n = F.col("total_visits")
    rated = stats.where((n >= 5) & (F.col("overtime_visits") > 0)).withColumns(
        _overtime_rates()
        | {
            "avg_scheduled_hours_h": hours(F.col("scheduled_us"), n),
            "avg_actual_hours_h": hours(F.col("actual_us"), n),
            "avg_hours_difference_h": hours(F.col("actual_us") - F.col("scheduled_us"), n),
        }
    )
    f, average = F.col("frequency_h"), F.col("avg_overtime_hours_h")
    severe, extreme = F.col("severe_overtime_frequency_h"), F.col("extreme_overtime_frequency_h")
    longest = F.col("max_overtime_hours_h")
    # Rungs, labels and weights of the report.
    scored = rated.withColumns(
        {
            "overtime_frequency_percentage_h": f,
            "overtime_severity": ladder(
                [
                    ((f >= h(50)) & (average >= h(2)), "CRITICAL"),
                    ((f >= h(30)) & (average >= h(1.5)), "HIGH"),
                    ((f >= h(20)) & (average >= h(1)), "MEDIUM"),
                    (f >= h(10), "LOW"),
                ],
                "MINIMAL",
            ),
            "overtime_pattern": ladder(
                [
                    (f >= h(50), "FREQUENT_OVERTIME"),
                    (severe >= h(20), "SEVERE_OVERTIME"),
                    (extreme >= h(10), "EXTREME_OVERTIME"),
                    (average >= h(2), "LONG_OVERTIME"),
                    (f >= h(20), "MODERATE_OVERTIME"),
                ],
                "OCCASIONAL_OVERTIME",
            ),
            "overtime_risk_score_h": thousandths_to_hundredths(
                weighted((f, 0.4), (above(average, h(1)), 20), (severe, 0.3), (above(longest, h(4)), 2))
            ),
        }
    )
    order = ["overtime_risk_score_h", "frequency_h", "total_overtime_hours_h"]
    return top(with_caregiver(scored, caregivers), order, limit).select(
        "caregiverId", "caregiver_name", "email", "phoneNumber", "status",
        "total_visits", "overtime_visits", "on_time_visits",
        *numbers(
            "avg_scheduled_hours", "avg_actual_hours", "avg_hours_difference",
            "avg_overtime_hours", "max_overtime_hours", "total_overtime_hours",
            "overtime_frequency_percentage", "severe_overtime_frequency", "extreme_overtime_frequency",
            "avg_overtime_percentage", "max_overtime_percentage",
        ),
        "first_visit_date", "last_visit_date", "active_days", "active_months", "last_overtime_date",
        "overtime_severity", "overtime_pattern",
        *numbers("overtime_risk_score"),
    )


def _insight_measures() -> Measures:
    extra, shift, period = F.col("overtime_us") > 0, F.col("shift_type"), F.col("time_period")
    weekend = F.col("day_type") == "WEEKEND"
    return (
        _overtime_measures()
        | added(
            weekend_visits=count(weekend),
            weekend_overtime=count(weekend & extra),
            extended_shifts=count(shift == "EXTENDED_SHIFT"),
            long_shifts=count(shift == "LONG_SHIFT"),
            normal_shifts=count(shift == "NORMAL_SHIFT"),
            short_shifts=count(shift == "SHORT_SHIFT"),
            early_morning_overtime=count((period == "EARLY_MORNING") & extra),
            evening_overtime=count((period == "EVENING") & extra),
            night_overtime=count((period == "NIGHT") & extra),
        )
        # months of the year seen, years merged
        | {"month_bits": (F.bit_or(bit(F.col("visit_month"))), F.bit_or("month_bits"))}
    )


INSIGHT = Figures("overtime_insight", overtime_rows, _insight_measures, lambda: F.col("visit_date"), days="active_days")

#: Both reports' figures, which are made of the same visits.
ALL_OVERTIME = Figures("all_overtime", overtime_rows, lambda: _report_measures() | _insight_measures(), lambda: F.col("visit_date"))


def overtime_insight(caregivers: DataFrame, visits: DataFrame, limit: int | None = VISIT_LIMIT) -> DataFrame:
    return overtime_insight_of(caregivers, INSIGHT.of(visits), limit)


def overtime_insight_of(caregivers: DataFrame, stats: DataFrame, limit: int | None = VISIT_LIMIT) -> DataFrame:
    """The report on figures per caregiver."""
    n, over = F.col("total_visits"), F.col("overtime_visits")
    rated = stats.where((n >= 5) & (over > 0)).withColumns(
        _overtime_rates()
        | {
            "weekend_overtime_rate_h": percent(F.col("weekend_overtime"), F.col("weekend_visits")),
            "active_months": F.bit_count("month_bits").cast("bigint"),
        }
    )
    f, average, weekend_rate = F.col("frequency_h"), F.col("avg_overtime_hours_h"), F.col("weekend_overtime_rate_h")
    severe, extended = F.col("severe_overtime_frequency_h"), F.col("extended_shifts")
    evening, night = F.col("evening_overtime"), F.col("night_overtime")
    longest = F.col("max_overtime_hours_h")
    # Weights, rungs, labels and texts of the report. The score is
    # unknown without weekend visits, like the rate it contains.
    risk = weighted(
        (f, 0.3), (above(average, h(1)), 15), (severe, 0.4), (weekend_rate, 0.2), (above(longest, h(4)), 3)
    )
    patterned = rated.withColumns(
        {
            "overtime_frequency_h": f,
            "risk": risk,
            "overtime_pattern_type": ladder(
                [
                    ((f >= h(60)) & (average >= h(2)), "CHRONIC_OVERTIME_WORKER"),
                    ((f >= h(40)) & (average >= h(1.5)), "FREQUENT_OVERTIME_WORKER"),
                    (severe >= h(30), "SEVERE_OVERTIME_PATTERN"),
                    (weekend_rate >= h(50), "WEEKEND_OVERTIME_SPECIALIST"),
                    ((extended > 0) & (extended * 5 >= n), "EXTENDED_SHIFT_WORKER"),
                    ((evening > 0) & (evening * 2 >= over), "EVENING_OVERTIME_PATTERN"),
                    ((night > 0) & (night * 10 >= over * 3), "NIGHT_OVERTIME_PATTERN"),
                    (f >= h(20), "MODERATE_OVERTIME_WORKER"),
                ],
                "OCCASIONAL_OVERTIME_WORKER",
            ),
        }
    )
    pattern, score = F.col("overtime_pattern_type"), F.col("risk")

    def says(kind: str, *parts: object) -> tuple[Column, Column]:
        return pattern == kind, F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    labelled = patterned.withColumns(
        {
            "overtime_risk_score_h": thousandths_to_hundredths(score),
            "risk_level": at_least(
                score,
                [(80, "CRITICAL_RISK"), (60, "HIGH_RISK"), (40, "MODERATE_RISK"), (20, "LOW_RISK")],
                "MINIMAL_RISK",
                scale=1000,
            ),
            "recommended_action": at_least(
                score,
                [
                    (80, "IMMEDIATE_INTERVENTION_REQUIRED"),
                    (60, "SCHEDULE_ADJUSTMENT_NEEDED"),
                    (40, "MONITOR_CLOSELY"),
                    (20, "PERIODIC_REVIEW"),
                ],
                "NORMAL_MONITORING",
                scale=1000,
            ),
            "pattern_insight": ladder(
                [
                    says(
                        "CHRONIC_OVERTIME_WORKER", "Chronic overtime worker with ", text2(f),
                        "% overtime frequency and average ", text1(average), " hours overtime per shift",
                    ),
                    says("FREQUENT_OVERTIME_WORKER", "Frequent overtime worker with ", text2(f), "% overtime frequency"),
                    says(
                        "SEVERE_OVERTIME_PATTERN", "Shows severe overtime pattern with ", text2(severe),
                        "% of shifts exceeding 2 hours overtime",
                    ),
                    says(
                        "WEEKEND_OVERTIME_SPECIALIST", "Specializes in weekend overtime with ", text2(weekend_rate),
                        "% weekend overtime rate",
                    ),
                    says(
                        "EXTENDED_SHIFT_WORKER", "Frequently works extended shifts (>12 hours) with ",
                        extended.cast("string"), " extended shifts",
                    ),
                    says(
                        "EVENING_OVERTIME_PATTERN", "Shows evening overtime pattern with ",
                        evening.cast("string"), " evening overtime shifts",
                    ),
                    says(
                        "NIGHT_OVERTIME_PATTERN", "Shows night overtime pattern with ",
                        night.cast("string"), " night overtime shifts",
                    ),
                    says("MODERATE_OVERTIME_WORKER", "Moderate overtime worker with ", text2(f), "% overtime frequency"),
                ],
                F.concat(F.lit("Occasional overtime worker with "), text2(f), F.lit("% overtime frequency")),
            ),
            "key_insight": ladder(
                [
                    (weekend_rate > h(50), "High weekend overtime rate suggests potential scheduling issues or weekend staffing shortages"),
                    (severe > h(30), "High severe overtime frequency indicates potential workload management issues"),
                    (evening * 10 > over * 6, "Evening overtime pattern suggests potential shift handover or evening workload issues"),
                    (night * 10 > over * 4, "Night overtime pattern suggests potential overnight care requirements"),
                    (extended * 10 > n * 3, "High number of extended shifts suggests potential staffing shortages or complex care needs"),
                    (average > h(3), "High average overtime hours suggests potential workload or scheduling inefficiencies"),
                ],
                "Standard overtime patterns observed",
            ),
        }
    )
    order = ["overtime_risk_score_h", "overtime_frequency_h", "total_overtime_hours_h"]
    return top(with_caregiver(labelled, caregivers), order, limit).select(
        "caregiverId", "caregiver_name", "email", "phoneNumber", "status",
        "total_visits", "overtime_visits", "on_time_visits",
        *numbers(
            "avg_overtime_hours", "max_overtime_hours", "total_overtime_hours", "avg_overtime_percentage",
            "overtime_frequency", "severe_overtime_frequency", "extreme_overtime_frequency",
        ),
        "weekend_visits", "weekend_overtime", *numbers("weekend_overtime_rate"),
        "extended_shifts", "long_shifts", "normal_shifts", "short_shifts",
        "early_morning_overtime", "evening_overtime", "night_overtime",
        "first_visit_date", "last_visit_date", "active_days", "active_months",
        "overtime_pattern_type", "risk_level", "recommended_action", *numbers("overtime_risk_score"),
        "pattern_insight", "key_insight",
    )

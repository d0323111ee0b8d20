"""Hand-written visits at the edges of every rule ladder."""

import datetime as dt
import statistics

import pytest

from tests.conftest import by_id
from visitlake.operators import facts
from visitlake.plans.abnormal import abnormal_visits, duration_stats
from visitlake.plans.documentation import comment_detail, doc_suspicion
from visitlake.plans.duration import visit_duration
from visitlake.plans.overtime import overtime, overtime_insight
from visitlake.plans.performance import top_performance
from visitlake.plans.reliability import reliability

REPORTS = [
    reliability, visit_duration, comment_detail, doc_suspicion, top_performance, abnormal_visits, overtime,
    overtime_insight,
]


@pytest.mark.parametrize("report", REPORTS)
def test_empty_input(rows, report):
    rows.caregiver("A")
    assert report(*rows.tables()).collect() == []


@pytest.mark.parametrize("report", REPORTS)
def test_no_limit_gives_every_row(rows, report):
    for i in range(70):
        rows.worked(f"C{i:02d}", 400, times=5, plan=60, note="x" * 40, length=40)
        rows.visit(f"C{i:02d}", start=0, end=60)
    for i in range(3):
        rows.worked("C00", 2000 + i, plan=60)
    limited, full = report(*rows.tables()), report(*rows.tables(), limit=None)
    assert set(limited.collect()) <= set(full.collect())
    assert full.count() >= (3 if report is abnormal_visits else 70)


def test_unknown_caregivers_are_left_out(rows):
    rows.worked("A", 60, times=3, plan=60)
    for _ in range(5):
        rows.visit("nobody", 0, 60, 0, 60, known=False)
    assert set(by_id(top_performance(*rows.tables()))) == {"A"}


def test_duration_flags_at_the_edges(rows, spark):
    expected = [
        (5, "TOO_SHORT_DURATION"), (6, "VALID_DURATION"), (0, "INVALID_DURATION"), (-3, "INVALID_DURATION"),
        (1440, "VALID_DURATION"), (1441, "EXCESSIVE_DURATION"),
    ]
    for minutes, _ in expected:
        rows.worked("A", minutes)
    rows.visit("A", clock_in=5).visit("A", clock_out=5).visit("A", 0, 60)
    _, visits = rows.tables()
    flags = [r.data_quality_flag for r in facts.duration_flags(visits).orderBy("carelogId").collect()]
    assert flags == [flag for _, flag in expected] + ["MISSING_CLOCK_OUT", "MISSING_CLOCK_IN"]


def test_duration_report(rows):
    for minutes in (30, 60, 240, 480, 481):
        rows.worked("A", minutes, plan=60)
    rows.worked("B", 90).visit("B", clock_in=5).visit("B", clock_in=5)
    rows.visit("C", clock_in=5).visit("C", clock_in=6).visit("C", clock_out=6)
    found = by_id(visit_duration(*rows.tables()))
    a = found["A"]
    assert (a.visits_under_1_hour, a.visits_1_to_4_hours, a.visits_4_to_8_hours, a.visits_over_8_hours) == (1, 2, 2, 1)
    hours = [m / 60 for m in (30, 60, 240, 480, 481)]
    assert a.avg_actual_duration_hours == 4.3 and a.median_actual_duration_hours == 4.0
    assert a.stddev_actual_duration_hours == round(statistics.stdev(hours), 2)
    assert a.avg_duration_difference_hours == 3.3 and a.data_quality_percentage == 100.0
    b = found["B"]
    assert (b.stddev_actual_duration_hours, b.median_actual_duration_hours, b.data_quality_percentage) == (None, 1.5, 33.33)
    c = found["C"]
    assert (c.avg_actual_duration_hours, c.median_actual_duration_hours, c.problematic_visits) == (None, None, 3)
    # without a known average last
    assert [r.caregiverId for r in visit_duration(*rows.tables()).collect()] == ["A", "B", "C"]


def test_median_of_an_even_number_rounds_half_up(rows):
    # (66.6 + 68.4) / 2 minutes = 1.125 hours; with whole minutes: 67 and 68 -> 67.5
    for minutes in (30, 67, 68, 300):
        rows.worked("A", minutes)
    assert by_id(visit_duration(*rows.tables()))["A"].median_actual_duration_hours == 1.13


def test_reliability_ladders(rows):
    # all missed: conditional rates unknown, severity unknown and sorted first
    for _ in range(5):
        rows.visit("missed", 0, 60)
    # never planned and never clocked: only the completion rate is low
    for _ in range(5):
        rows.visit("unplanned")
    for i in range(10):
        rows.visit("late", 0, 60, 1 if i < 4 else 0, 60)
    for i in range(10):
        rows.visit("early", 0, 60, 0, 59 if i < 4 else 60)
    # exactly 20% late is not more than 20%
    for i in range(10):
        rows.visit("edge", 0, 60, 1 if i < 2 else 0, 60)
    for _ in range(4):
        rows.visit("few", 0, 60)
    frame = reliability(*rows.tables())
    found = by_id(frame)
    assert set(found) == {"missed", "unplanned", "late", "early"}
    assert (found["missed"].severity_score, found["missed"].late_arrival_rate) == (None, None)
    assert (found["missed"].severity_level, found["missed"].primary_issue_type) == ("CRITICAL", "HIGH_ABSENTEEISM")
    assert (found["unplanned"].severity_level, found["unplanned"].primary_issue_type) == ("LOW", "LOW_COMPLETION_RATE")
    assert (found["late"].severity_score, found["late"].primary_issue_type) == (12.0, "FREQUENT_LATE_ARRIVALS")
    assert (found["early"].severity_score, found["early"].primary_issue_type) == (8.0, "FREQUENT_EARLY_DEPARTURES")
    order = [r.caregiverId for r in frame.collect()]
    assert order == ["missed", "unplanned", "late", "early"]


def test_performance(rows):
    rows.visit("A", 0, 60, 0, 60).visit("A", 10, 50, 5, 55).visit("A", 0, 60, 1, 60)
    rows.visit("A", clock_in=30).visit("A", clock_out=30, day=1).visit("A", 0, 60, day=2)
    rows.visit("A", 0, 60, 600, 540, day=3)
    a = by_id(top_performance(*rows.tables()))["A"]
    assert (a.total_scheduled_visits, a.actual_visits, a.complete_visits, a.partial_visits, a.no_show_visits) == (7, 6, 4, 2, 1)
    assert a.actual_visits + a.no_show_visits == a.total_scheduled_visits
    # 60 + 50 + 59 - 60 minutes: a clock-out before the clock-in counts negative
    assert (a.total_work_hours, a.avg_work_hours, a.avg_hours_per_day) == (1.82, 0.45, 0.91)
    assert (a.punctual_visits, a.actual_active_days, a.completion_rate, a.complete_visit_rate) == (2, 2, 85.71, 57.14)


def test_distinct_days_and_months(rows):
    for day in (0, 0, 1, 30, 366, 366 + 31):
        rows.worked("A", 90, plan=60, day=day)
    caregivers, visits = rows.tables()
    assert by_id(top_performance(caregivers, visits))["A"].actual_active_days == 5
    by_year = by_id(overtime(caregivers, visits))["A"]
    # March and April of two years: four months, or two months of the year
    assert (by_year.active_days, by_year.active_months) == (5, 4)
    assert by_id(overtime_insight(caregivers, visits))["A"].active_months == 2


def test_overtime(rows):
    for minutes in (60, 61, 180, 181, 300):
        rows.worked("A", minutes, plan=60)
    rows.worked("never", 50, times=5, plan=60).worked("few", 100, times=4, plan=60)
    found = by_id(overtime(*rows.tables()))
    assert set(found) == {"A"}
    a = found["A"]
    assert (a.overtime_visits, a.on_time_visits, a.overtime_frequency_percentage) == (4, 1, 80.0)
    # more than two hours: 121 and 240 minutes; more than four: none
    assert (a.severe_overtime_frequency, a.extreme_overtime_frequency) == (40.0, 0.0)
    assert (a.total_overtime_hours, a.avg_overtime_hours, a.max_overtime_hours) == (8.03, 2.01, 4.0)
    # overtime hours are divided by scheduled seconds and by 3600 again
    assert (a.avg_overtime_percentage, a.max_overtime_percentage) == (None, 0.0)
    assert (a.overtime_severity, a.overtime_pattern) == ("CRITICAL", "FREQUENT_OVERTIME")
    assert a.overtime_risk_score == round(0.4 * 80 + 20 * 1.01 + 0.3 * 40 + 2 * 0, 2)
    assert a.last_overtime_date == dt.date(2024, 3, 4)


def test_overtime_percentage_needs_a_tiny_plan(rows):
    rows.worked("A", 1301, times=5, plan=1)
    a = by_id(overtime(*rows.tables()))["A"]
    # 100 * 21.67 h / 60 s / 3600
    assert (a.avg_overtime_percentage, a.max_overtime_percentage) == (0.01, 0.01)


def test_insight_without_weekend_visits(rows):
    rows.worked("weekday", 240, times=5, plan=60)
    for day in (5, 6, 5, 6, 0):  # Saturday, Sunday
        rows.worked("weekend", 120, plan=60, day=day)
    frame = overtime_insight(*rows.tables())
    found = by_id(frame)
    first = found["weekday"]
    assert (first.weekend_overtime_rate, first.overtime_risk_score, first.risk_level) == (None, None, "MINIMAL_RISK")
    assert first.pattern_insight == (
        "Chronic overtime worker with 100.00% overtime frequency and average 3.0 hours overtime per shift"
    )
    assert found["weekend"].weekend_visits == 4
    assert found["weekend"].key_insight.startswith("High weekend overtime rate")
    assert frame.first().caregiverId == "weekday"  # an unknown score sorts first


def test_comment_lengths_at_the_edges(rows):
    expected = {
        4: ("VERY_SHORT", 1), 9: ("VERY_SHORT", 1), 10: ("SHORT", 2), 49: ("SHORT", 2), 50: ("MEDIUM", 3),
        99: ("MEDIUM", 3), 100: ("LONG", 4), 199: ("LONG", 4), 200: ("VERY_LONG", 5),
    }
    for n in expected:
        rows.worked("A", 60, note="x1" * n, length=n)
    rows.worked("A", 60, note="x", length=0).worked("A", 60, note="", length=5).worked("A", 60, note=None, length=5)
    rows.worked("A", 60, note="x", length=None).worked("A", 0, note="x", length=9)
    _, visits = rows.tables()
    found = {r.comment_length: (r.comment_category, r.comment_detail_score) for r in facts.comment_categories(visits).collect()}
    assert found == expected


def test_comment_scores(rows):
    for n in (250, 150, 60, 20, 20, 5):
        rows.worked("A", 60, note="x" * n, length=n)
    a = by_id(comment_detail(*rows.tables()))["A"]
    # only the last term of the consistency score is divided by the number of visits
    assert a.comment_consistency_score == round(2 + 1.5 + 1 + 0.5 * 2 / 6, 2)
    mean = 505 / 6
    detailed, weighted = 100 * 2 / 6, (2 * 2 + 1.5 + 2 + 0.5) / 6
    assert a.comment_professionalism_score == round(0.4 * mean + 0.3 * detailed + 10 * weighted + 2 * (mean - 10), 2)
    assert (a.documentation_pattern, a.comment_quality_rating, a.comment_efficiency_rating) == (
        "REGULAR_DOCUMENTER", "AVERAGE", "VERY_EFFICIENT",
    )
    assert a.insight_description == (
        "Regularly provides documentation in 33.33% of visits with average length of 84 characters"
    )


def test_anomalies_at_the_edges(rows):
    cases = [
        ("abcd", 4, "VERY_SHORT_DOCUMENTATION", 8), ("abcde", 5, "SHORT_DOCUMENTATION", 6),
        ("abcdefghi", 9, "SHORT_DOCUMENTATION", 6), ("x1" * 500, 1000, "NORMAL_DOCUMENTATION", 1),
        ("x1" * 500, 1001, "EXCESSIVELY_LONG", 7), ("OK", 12, "GENERIC_COMMENT", 5), ("Done", 12, "GENERIC_COMMENT", 5),
        ("copy of note 1", 14, "SUSPECTED_COPY_PASTE", 8), ("COPY of note 1", 14, "NORMAL_DOCUMENTATION", 1),
        ("it is the same 1", 16, "DUPLICATE_CONTENT_SUSPECTED", 7), ("a" * 19, 19, "TOO_GENERIC", 4),
        ("a" * 20, 20, "NORMAL_DOCUMENTATION", 1), ("two words\nhere", 14, "TOO_GENERIC", 4),
        ("ends in a break\n", 16, "TOO_GENERIC", 4), ("no break space", 14, "NORMAL_DOCUMENTATION", 1),
    ]
    for note, n, *_ in cases:
        rows.worked("A", 60, note=note, length=n)
    _, visits = rows.tables()
    found = [(r.anomaly_type, r.suspicion_score) for r in facts.doc_anomalies(visits).orderBy("carelogId").collect()]
    assert found == [(kind, score) for _, _, kind, score in cases]


def test_suspicion(rows):
    rows.worked("A", 60, times=7, note="abc", length=3).worked("A", 60, times=3, note="a perfectly normal note 1", length=25)
    a = by_id(doc_suspicion(*rows.tables()))["A"]
    assert (a.suspicious_percentage, a.short_percentage, a.avg_suspicion_score, a.max_suspicion_score) == (70.0, 70.0, 5.9, 8.0)
    assert a.suspicion_risk_score == 0.4 * 70 + 5 * 5.9 + 2 * 2 + 10
    assert (a.suspicion_level, a.primary_issue_type, a.recommended_action) == (
        "VERY_SUSPICIOUS", "FREQUENT_SHORT_DOCS", "DETAILED_REVIEW_NEEDED",
    )
    assert a.insight_description == "Very suspicious documentation patterns with 70.00% of records showing issues"


def test_abnormal_by_range_and_quartiles(rows):
    rows.worked("A", 100, times=20).worked("A", 101, times=20)
    rows.worked("A", 14).worked("A", 15).worked("A", 90).worked("A", 300).worked("B", 1440).worked("B", 1441)
    found = {r.actual_duration_minutes: r for r in abnormal_visits(*rows.tables()).collect()}
    assert {m: (r.atypical_type, r.severity_level) for m, r in found.items()} == {
        14.0: ("EXTREMELY_SHORT", "CRITICAL"), 1441.0: ("EXTREMELY_LONG", "CRITICAL"),
        15.0: ("STATISTICALLY_SHORT", "HIGH"), 90.0: ("STATISTICALLY_SHORT", "HIGH"),
        300.0: ("STATISTICALLY_LONG", "HIGH"), 1440.0: ("STATISTICALLY_LONG", "HIGH"),
    }
    _, visits = rows.tables()
    stats = duration_stats(visits).first()
    assert (stats.q1_us, stats.q3_us) == (100 * 60e6, 101 * 60e6)


def test_abnormal_by_deviation(rows):
    # wide quartiles, so that the mean and deviation fence is the nearer one
    for minutes in [400] * 30 + [600] * 30 + [205, 796]:
        rows.worked("A", minutes)
    kinds = {r.actual_duration_minutes: r.atypical_type for r in abnormal_visits(*rows.tables()).collect()}
    assert kinds == {205.0: "SIGNIFICANTLY_SHORT", 796.0: "SIGNIFICANTLY_LONG"}


def test_no_deviation(rows):
    rows.worked("A", 100, times=5).worked("A", 5)
    (row,) = abnormal_visits(*rows.tables()).collect()
    assert (row.atypical_type, row.z_score) == ("EXTREMELY_SHORT", None)


def test_severity_sorts_as_text(rows):
    for minutes in [400] * 30 + [600] * 30 + [205]:
        rows.worked("A", minutes)
    rows.worked("A", 3)
    assert [r.severity_level for r in abnormal_visits(*rows.tables()).collect()] == ["MEDIUM", "CRITICAL"]
    assert [r.severity_level for r in abnormal_visits(*rows.tables(), limit=1).collect()] == ["MEDIUM"]

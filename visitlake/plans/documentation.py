"""Documentation: how detailed comments are, and how far they can be trusted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.functions.exact import (
    above, exact_sum, h, hours, hundredths, percent, text0, text2, thousandths_to_hundredths, weighted, whole,
)
from visitlake.functions.ladders import at_least, ladder
from visitlake.operators.facts import added, comment_categories, commented_visits, count, doc_anomalies, largest, smallest
from visitlake.operators.figures import Figures, Measures
from visitlake.plans.common import CAREGIVER_LIMIT, numbers, top, with_caregiver


def _text(*parts: object) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _comment_detail_measures() -> Measures:
    kind, length, pace = F.col("comment_category"), F.col("comment_length"), F.col("chars_per_hour_h")
    return (
        added(
            total_commented_visits=F.count("*"),
            chars=exact_sum(length),
            very_long_comments=count(kind == "VERY_LONG"),
            long_comments=count(kind == "LONG"),
            medium_comments=count(kind == "MEDIUM"),
            short_comments=count(kind == "SHORT"),
            very_short_comments=count(kind == "VERY_SHORT"),
            detail=F.sum("comment_detail_score"),
            actual_us=exact_sum(F.col("actual_us")),
            pace_sum=exact_sum(pace),
            pace_count=F.count(pace),
            overnight_comments=count(F.col("overnight_shift")),
            weekend_comments=count(F.col("weekend_shift")),
        )
        | smallest(min_length=length, min_us=F.col("actual_us"), first_comment_date=F.col("visit_date"))
        | largest(
            max_length=length, max_us=F.col("actual_us"), max_pace_h=pace, last_comment_date=F.col("visit_date")
        )
    )


COMMENT_DETAIL = Figures("comment_detail", comment_categories, _comment_detail_measures, lambda: F.col("visit_date"), days="comment_active_days")


def comment_detail(caregivers: DataFrame, visits: DataFrame, limit: int | None = CAREGIVER_LIMIT) -> DataFrame:
    return comment_detail_of(caregivers, COMMENT_DETAIL.of(visits), limit)


def comment_detail_of(caregivers: DataFrame, stats: DataFrame, limit: int | None = CAREGIVER_LIMIT) -> DataFrame:
    """The report on figures per caregiver."""
    n = F.col("total_commented_visits")
    vl, long, medium = F.col("very_long_comments"), F.col("long_comments"), F.col("medium_comments")
    short, vs = F.col("short_comments"), F.col("very_short_comments")
    wn = whole(n)
    # 0.4 * mean length + 0.3 * detailed share + 10 * weighted classes + 2 * (mean pace - 10 if positive),
    # all over n; the mean pace is a mean of two-decimal values
    professional = hundredths(
        whole(F.col("chars")) * h(0.4) + whole(long + vl) * h(0.3 * 100)
        + whole(long + vl) * h(10 * 2) + whole(medium) * h(10 * 1.5) + whole(short) * h(10 * 1) + whole(vs) * h(10 * 0.5)
        + F.greatest(whole(0), whole(F.coalesce("pace_sum", F.lit(0))) - wn * h(10)) * 2,
        wn * 100,
    )
    # 2 VL + 1.5 L + M, plus half the share (not the number) of short comments
    consistency = hundredths(whole(vl * 4 + long * 3 + medium * 2) * wn + whole(short), wn * 2)
    scored = stats.where(n >= 3).withColumns(
        {
            "avg_comment_length_h": hundredths(F.col("chars"), n),
            "detailed_comment_percentage_h": percent(long + vl, n),
            "medium_comment_percentage_h": percent(medium, n),
            "brief_comment_percentage_h": percent(short + vs, n),
            "avg_comment_detail_score_h": hundredths(F.col("detail"), n),
            "comment_consistency_score_h": consistency,
            "comment_professionalism_score_h": professional,
            "avg_visit_duration_hours_h": hours(F.col("actual_us"), n),
            "max_visit_duration_hours_h": hours(F.col("max_us")),
            "min_visit_duration_hours_h": hours(F.col("min_us")),
            "avg_chars_per_hour_h": hundredths(F.col("pace_sum"), whole(F.col("pace_count")) * 100),
            "max_chars_per_hour_h": F.col("max_pace_h"),
        }
    )
    share, average = F.col("detailed_comment_percentage_h"), F.col("avg_comment_length_h")
    score, steady = F.col("avg_comment_detail_score_h"), F.col("comment_consistency_score_h")
    mean = text0(average)
    # Rungs, labels and texts of the report.
    patterns = [
        (
            (share >= h(70)) & (average >= h(100)), "HIGHLY_DETAILED_DOCUMENTER",
            _text("Consistently provides detailed documentation in ", text2(share), "% of visits with average length of ", mean, " characters"),
        ),
        (
            (share >= h(50)) & (average >= h(75)), "DETAILED_DOCUMENTER",
            _text("Frequently provides detailed documentation in ", text2(share), "% of visits with average length of ", mean, " characters"),
        ),
        (
            (share >= h(30)) & (average >= h(50)), "REGULAR_DOCUMENTER",
            _text("Regularly provides documentation in ", text2(share), "% of visits with average length of ", mean, " characters"),
        ),
        (
            average >= h(100), "LONG_COMMENT_SPECIALIST",
            _text("Specializes in long comments with average length of ", mean, " characters"),
        ),
        (
            share >= h(50), "FREQUENT_COMMENTER",
            _text("Frequently comments but with moderate detail, average length of ", mean, " characters"),
        ),
    ]
    labelled = scored.withColumns(
        {
            "documentation_pattern": ladder([(c, label) for c, label, _ in patterns], "OCCASIONAL_COMMENTER"),
            "insight_description": ladder(
                [(c, text) for c, _, text in patterns],
                _text("Occasional commenter with average length of ", mean, " characters"),
            ),
            "comment_quality_rating": ladder(
                [
                    ((score >= h(4)) & (steady >= h(3)), "EXCELLENT"),
                    ((score >= h(3)) & (steady >= h(2)), "GOOD"),
                    ((score >= h(2)) & (steady >= h(1)), "AVERAGE"),
                    (score >= h(1), "POOR"),
                ],
                "VERY_POOR",
            ),
            "comment_efficiency_rating": at_least(
                F.col("avg_chars_per_hour_h"),
                [(50, "VERY_EFFICIENT"), (30, "EFFICIENT"), (15, "MODERATE"), (5, "SLOW")],
                "VERY_SLOW",
            ),
        }
    )
    order = ["comment_professionalism_score_h", "avg_comment_length_h", "detailed_comment_percentage_h"]
    return top(with_caregiver(labelled, caregivers), order, limit).select(
        "caregiverId", "caregiver_name", "email", "phoneNumber", "status", "total_commented_visits",
        *numbers("avg_comment_length"),
        F.col("max_length").cast("double").alias("max_comment_length"),
        F.col("min_length").cast("double").alias("min_comment_length"),
        F.col("chars").cast("double").alias("total_comment_chars"),
        "very_long_comments", "long_comments", "medium_comments", "short_comments", "very_short_comments",
        *numbers(
            "detailed_comment_percentage", "medium_comment_percentage", "brief_comment_percentage",
            "avg_comment_detail_score", "comment_consistency_score", "comment_professionalism_score",
            "avg_visit_duration_hours", "max_visit_duration_hours", "min_visit_duration_hours",
            "avg_chars_per_hour", "max_chars_per_hour",
        ),
        "overnight_comments", "weekend_comments",
        "first_comment_date", "last_comment_date", "comment_active_days",
        "documentation_pattern", "comment_quality_rating", "comment_efficiency_rating", "insight_description",
    )


def _doc_suspicion_measures() -> Measures:
    kind = F.col("anomaly_type")
    return (
        added(
            total_documented_visits=F.count("*"),
            suspicious_records=count(kind != "NORMAL_DOCUMENTATION"),
            missing_docs=count(kind == "MISSING_DOCUMENTATION"),
            very_short_docs=count(kind == "VERY_SHORT_DOCUMENTATION"),
            short_docs=count(kind == "SHORT_DOCUMENTATION"),
            excessively_long_docs=count(kind == "EXCESSIVELY_LONG"),
            generic_comments=count(kind == "GENERIC_COMMENT"),
            length_mismatches=count(kind == "LENGTH_MISMATCH"),
            copy_paste_suspected=count(kind == "SUSPECTED_COPY_PASTE"),
            duplicate_suspected=count(kind == "DUPLICATE_CONTENT_SUSPECTED"),
            too_generic=count(kind == "TOO_GENERIC"),
            score_sum=F.sum("suspicion_score"),
        )
        | smallest(first_doc_date=F.col("visit_date"))
        | largest(last_doc_date=F.col("visit_date"), max_score=F.col("suspicion_score"))
    )


DOC_SUSPICION = Figures("doc_suspicion", doc_anomalies, _doc_suspicion_measures, lambda: F.col("visit_date"), days="doc_active_days")

#: Both reports' figures, which are made of the same visits.
DOCUMENTATION = Figures(
    "documentation", commented_visits, lambda: _comment_detail_measures() | _doc_suspicion_measures(), lambda: F.col("visit_date")
)


def doc_suspicion(caregivers: DataFrame, visits: DataFrame, limit: int | None = CAREGIVER_LIMIT) -> DataFrame:
    return doc_suspicion_of(caregivers, DOC_SUSPICION.of(visits), limit)


def doc_suspicion_of(caregivers: DataFrame, stats: DataFrame, limit: int | None = CAREGIVER_LIMIT) -> DataFrame:
    """The report on figures per caregiver."""
    n, suspicious = F.col("total_documented_visits"), F.col("suspicious_records")
    rated = stats.where(n >= 3).withColumns(
        {
            "suspicious_percentage_h": percent(suspicious, n),
            "missing_percentage_h": percent(F.col("missing_docs"), n),
            "short_percentage_h": percent(F.col("very_short_docs") + F.col("short_docs"), n),
            "generic_percentage_h": percent(F.col("generic_comments"), n),
            "avg_suspicion_score_h": hundredths(F.col("score_sum"), n),
        }
    )
    share, missing = F.col("suspicious_percentage_h"), F.col("missing_percentage_h")
    short, generic = F.col("short_percentage_h"), F.col("generic_percentage_h")
    copied, repeated = F.col("copy_paste_suspected") > 0, F.col("duplicate_suspected") > 0
    # Weights, rungs, labels and texts of the report.
    risk = weighted(
        (share, 0.4), (F.col("avg_suspicion_score_h"), 5), (above(suspicious, 5) * 100, 2),
        (F.when(F.col("max_score") >= 8, h(10)).otherwise(0), 1),
    )
    labelled = rated.withColumn("risk", risk).withColumns(
        {
            "suspicion_risk_score_h": thousandths_to_hundredths(F.col("risk")),
            "suspicion_level": at_least(
                share,
                [
                    (80, "HIGHLY_SUSPICIOUS"), (60, "VERY_SUSPICIOUS"), (40, "SUSPICIOUS"),
                    (20, "MODERATELY_SUSPICIOUS"), (10, "SLIGHTLY_SUSPICIOUS"),
                ],
                "NORMAL",
            ),
            "primary_issue_type": ladder(
                [
                    (missing >= h(50), "FREQUENT_MISSING_DOCS"),
                    (short >= h(60), "FREQUENT_SHORT_DOCS"),
                    (generic >= h(40), "FREQUENT_GENERIC_COMMENTS"),
                    (copied, "COPY_PASTE_DETECTED"),
                    (repeated, "DUPLICATE_CONTENT_DETECTED"),
                    (F.col("length_mismatches") > 0, "LENGTH_MISMATCH_DETECTED"),
                    (F.col("excessively_long_docs") > 0, "EXCESSIVELY_LONG_DOCS"),
                ],
                "MINOR_ISSUES",
            ),
            "recommended_action": at_least(
                F.col("risk"),
                [
                    (80, "IMMEDIATE_INVESTIGATION_REQUIRED"), (60, "DETAILED_REVIEW_NEEDED"),
                    (40, "MONITOR_CLOSELY"), (20, "PERIODIC_REVIEW"),
                ],
                "NORMAL_MONITORING",
                scale=1000,
            ),
            "insight_description": ladder(
                [
                    (share >= h(80), _text("Highly suspicious documentation patterns with ", text2(share), "% of records showing issues")),
                    (share >= h(60), _text("Very suspicious documentation patterns with ", text2(share), "% of records showing issues")),
                    (share >= h(40), _text("Suspicious documentation patterns with ", text2(share), "% of records showing issues")),
                    (missing >= h(50), _text("Frequently missing documentation in ", text2(missing), "% of visits")),
                    (short >= h(60), _text("Frequently provides very short documentation in ", text2(short), "% of visits")),
                    (generic >= h(40), _text("Frequently uses generic comments in ", text2(generic), "% of visits")),
                    (copied, "Suspected copy-paste behavior detected in documentation"),
                    (repeated, "Suspected duplicate content in documentation"),
                ],
                "Minor documentation issues detected",
            ),
        }
    )
    order = ["risk", "suspicious_percentage_h", "suspicious_records"]
    return top(with_caregiver(labelled, caregivers), order, limit).select(
        "caregiverId", "caregiver_name", "email", "phoneNumber", "status",
        "total_documented_visits", "suspicious_records", *numbers("suspicious_percentage"),
        "missing_docs", "very_short_docs", "short_docs", "excessively_long_docs", "generic_comments",
        "length_mismatches", "copy_paste_suspected", "duplicate_suspected", "too_generic",
        *numbers("missing_percentage", "short_percentage", "generic_percentage", "avg_suspicion_score"),
        F.col("max_score").cast("double").alias("max_suspicion_score"),
        "first_doc_date", "last_doc_date", "doc_active_days",
        "suspicion_level", "primary_issue_type", *numbers("suspicion_risk_score"),
        "recommended_action", "insight_description",
    )



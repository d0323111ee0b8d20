"""Row-level visit features and the kinds of measures the reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.functions.exact import HOUR_US, hundredths, whole
from visitlake.functions.ladders import ladder
from visitlake.functions.timing import elapsed, is_weekend, sunday_first


class _Visit:
    """Expressions over one visit row, built on use because they need a session."""

    plan_start = property(lambda self: F.col("startDatetime"))
    plan_end = property(lambda self: F.col("endDatetime"))
    clock_in = property(lambda self: F.col("clockInActualDatetime"))
    clock_out = property(lambda self: F.col("clockOutActualDatetime"))

    actual_us = property(lambda self: elapsed(self.clock_in, self.clock_out))
    scheduled_us = property(lambda self: elapsed(self.plan_start, self.plan_end))

    any_clock = property(lambda self: self.clock_in.isNotNull() | self.clock_out.isNotNull())
    both_clocks = property(lambda self: self.clock_in.isNotNull() & self.clock_out.isNotNull())
    no_clock = property(lambda self: self.clock_in.isNull() & self.clock_out.isNull())

    @property
    def worked(self) -> Column:
        return self.both_clocks & (self.clock_in < self.clock_out)

    @property
    def planned(self) -> Column:
        return self.plan_start.isNotNull() & self.plan_end.isNotNull() & (self.plan_start < self.plan_end)

    @property
    def missed(self) -> Column:
        return (self.plan_start.isNotNull() | self.plan_end.isNotNull()) & self.no_clock

    @property
    def late(self) -> Column:
        return F.coalesce(self.clock_in > self.plan_start, F.lit(False))

    @property
    def early(self) -> Column:
        return F.coalesce(self.clock_out < self.plan_end, F.lit(False))

    @property
    def overtime_us(self) -> Column:
        excess = F.greatest(F.lit(0).cast("bigint"), self.actual_us - self.scheduled_us)
        return F.when(self.worked & self.plan_start.isNotNull() & self.plan_end.isNotNull(), excess)

    @property
    def documented(self) -> Column:
        text = F.col("documentation")
        return text.isNotNull() & (text != "") & (F.col("generalCommentCharCount") > 0)


visit = _Visit()


def visit_facts(visits: DataFrame) -> DataFrame:
    """Durations in microseconds, attendance flags and calendar fields of each visit."""
    return visits.select(
        "carelogId",
        "caregiverId",
        visit.actual_us.alias("actual_us"),
        visit.scheduled_us.alias("scheduled_us"),
        visit.overtime_us.alias("overtime_us"),
        visit.any_clock.alias("done"),
        visit.missed.alias("missed"),
        visit.late.alias("late"),
        visit.early.alias("early"),
        F.to_date(visit.clock_in).alias("visit_date"),
        sunday_first(visit.clock_in).alias("day_of_week"),
        F.hour(visit.clock_in).alias("start_hour"),
    )


def duration_flag() -> Column:
    return ladder(
        [
            (visit.no_clock, "NO_ACTUAL_TIMES"),
            (visit.clock_in.isNull(), "MISSING_CLOCK_IN"),
            (visit.clock_out.isNull(), "MISSING_CLOCK_OUT"),
            (visit.clock_in >= visit.clock_out, "INVALID_DURATION"),
            (visit.actual_us > 24 * HOUR_US, "EXCESSIVE_DURATION"),
            (visit.actual_us < HOUR_US // 10, "TOO_SHORT_DURATION"),
        ],
        "VALID_DURATION",
    )


def duration_flags(visits: DataFrame) -> DataFrame:
    """Visits with at least one clock time, their valid durations and quality flag."""
    return visits.where(visit.any_clock).select(
        "carelogId",
        "caregiverId",
        F.when(visit.worked, visit.actual_us).alias("actual_us"),
        F.when(visit.planned, visit.scheduled_us).alias("scheduled_us"),
        F.when(visit.worked & visit.planned, visit.actual_us - visit.scheduled_us).alias("difference_us"),
        duration_flag().alias("data_quality_flag"),
    )


def _comment_ladder(values: list[object], none: object) -> Column:
    n = F.col("generalCommentCharCount")
    text = F.col("documentation")
    empty = text.isNull() | (text == "") | n.isNull() | (n == 0)
    # Comment lengths at which the category changes.
    cuts = [10, 50, 100, 200]
    return ladder([(empty, none), *[(n < cut, value) for cut, value in zip(cuts, values)]], values[-1])


def comment_categories(visits: DataFrame) -> DataFrame:
    """Worked visits with a comment: length class, detail score and writing speed."""
    return _commented(visits, _category_columns())


def _commented(visits: DataFrame, columns: list[Column]) -> DataFrame:
    return visits.where(visit.worked & visit.documented).select("carelogId", "caregiverId", *columns)


def _category_columns() -> list[Column]:
    n = F.col("generalCommentCharCount")
    return [
        n.alias("comment_length"),
        F.to_date(visit.clock_in).alias("visit_date"),
        visit.actual_us.alias("actual_us"),
        _comment_ladder(["VERY_SHORT", "SHORT", "MEDIUM", "LONG", "VERY_LONG"], "NO_COMMENT").alias("comment_category"),
        _comment_ladder([1, 2, 3, 4, 5], 0).alias("comment_detail_score"),
        (F.col("documentation").isNotNull() & (F.col("documentation") != "")).alias("has_comment"),
        F.when(visit.actual_us > 0, hundredths(whole(n) * HOUR_US, visit.actual_us)).alias("chars_per_hour_h"),
        F.col("status").alias("visit_status"),
        (F.to_date(visit.clock_in) != F.to_date(visit.clock_out)).alias("overnight_shift"),
        is_weekend(visit.clock_in).alias("weekend_shift"),
    ]


def _anomaly_rungs() -> list[tuple[Column, str, int]]:
    text, n = F.col("documentation"), F.col("generalCommentCharCount")
    # The rungs of the documentation ladder and their scores.
    return [
        (text.isNull() | (text == ""), "MISSING_DOCUMENTATION", 10),
        (n < 5, "VERY_SHORT_DOCUMENTATION", 8),
        (n < 10, "SHORT_DOCUMENTATION", 6),
        (n > 1000, "EXCESSIVELY_LONG", 7),
        (F.lower(text).isin("ok", "fine", "good", "completed", "done", "finished"), "GENERIC_COMMENT", 5),
        ((F.length(text) > 0) & (n == 0), "LENGTH_MISMATCH", 9),
        (text.contains("copy") | text.contains("paste"), "SUSPECTED_COPY_PASTE", 8),
        (text.contains("same") | text.contains("identical"), "DUPLICATE_CONTENT_SUSPECTED", 7),
        ((F.length(text) < 20) & text.rlike(r"\A[A-Za-z \t\n\r\f\x0B]+\z"), "TOO_GENERIC", 4),
    ]


def doc_anomalies(visits: DataFrame) -> DataFrame:
    """Worked visits with a comment: documentation anomaly and suspicion score."""
    return _commented(visits, [F.to_date(visit.clock_in).alias("visit_date"), *_anomaly_columns()])


def _anomaly_columns() -> list[Column]:
    rungs = _anomaly_rungs()
    return [
        ladder([(c, kind) for c, kind, _ in rungs], "NORMAL_DOCUMENTATION").alias("anomaly_type"),
        ladder([(c, score) for c, _, score in rungs], 1).alias("suspicion_score"),
    ]


def commented_visits(visits: DataFrame) -> DataFrame:
    """Worked visits with a comment: both the categories and the anomalies of each."""
    return _commented(visits, [*_category_columns(), *_anomaly_columns()])


# A shift longer than this many hours is of this kind.
SHIFT_HOURS = [(12, "EXTENDED_SHIFT"), (8, "LONG_SHIFT"), (4, "NORMAL_SHIFT")]


def overtime_rows(visits: DataFrame) -> DataFrame:
    """Fully planned and worked visits: overtime, shift length and time of day.

    The percentage divides overtime hours by scheduled *seconds* and once more by
    3600, as the reports define it, so it is 0.00 unless the plan was tiny.
    """
    hour = F.hour(visit.clock_in)
    return visits.where(visit.worked & visit.planned).select(
        "carelogId",
        "caregiverId",
        visit.actual_us.alias("actual_us"),
        visit.scheduled_us.alias("scheduled_us"),
        visit.overtime_us.alias("overtime_us"),
        hundredths(whole(visit.overtime_us) * 100, whole(visit.scheduled_us) * (3600 * 3600)).alias("overtime_percentage_h"),
        F.to_date(visit.clock_in).alias("visit_date"),
        sunday_first(visit.clock_in).alias("day_of_week"),
        hour.alias("start_hour"),
        F.month(visit.clock_in).alias("visit_month"),
        ladder(
            [(visit.actual_us > h * HOUR_US, kind) for h, kind in SHIFT_HOURS], "SHORT_SHIFT"
        ).alias("shift_type"),
        ladder(
            [(hour < 6, "EARLY_MORNING"), (hour < 12, "MORNING"), (hour < 18, "AFTERNOON"), (hour < 24, "EVENING")],
            "NIGHT",
        ).alias("time_period"),
        F.when(is_weekend(visit.clock_in), "WEEKEND").otherwise("WEEKDAY").alias("day_type"),
    )


def count(condition: Column) -> Column:
    """Rows where the condition holds, 0 when there are none."""
    return F.count_if(condition)


def added(**aggregates: Column) -> dict[str, tuple[Column, Column]]:
    """Measures whose partial values are summed."""
    return {name: (agg, F.sum(name)) for name, agg in aggregates.items()}


def smallest(**columns: Column) -> dict[str, tuple[Column, Column]]:
    return {name: (F.min(c), F.min(name)) for name, c in columns.items()}


def largest(**columns: Column) -> dict[str, tuple[Column, Column]]:
    return {name: (F.max(c), F.max(name)) for name, c in columns.items()}



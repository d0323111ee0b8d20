"""Reports over kept figures: equal to the full scan after every load, and no visit is read for them."""

import datetime as dt
import random

import pytest

from visitlake.plans import documentation, duration, overtime, performance, reliability, report_state
from visitlake.plans.report_state import ReportState
from visitlake.schemas import CARELOG
from visitlake.session import fresh_path
from visitlake.sources.tables import append, read_table, table_path

FULL = {
    "reliability": reliability.reliability,
    "top_performance": performance.top_performance,
    "comment_detail": documentation.comment_detail,
    "doc_suspicion": documentation.doc_suspicion,
    "overtime": overtime.overtime,
    "overtime_insight": overtime.overtime_insight,
    "visit_duration": duration.visit_duration,
}
NOTES = [None, "", "ok", "copy of last time", "walked in the garden and had tea afterwards", "x" * 300]


def visits(spark, seed, size, who="ABCDE"):
    """Random visits, ties and missing values among them; the first caregiver has many."""
    rng, rows = random.Random(seed), []
    for k in range(size):
        start = dt.datetime(2023, 1, 1) + dt.timedelta(days=rng.randrange(500), minutes=rng.randrange(1440))
        end = start + dt.timedelta(minutes=rng.choice([60, 240, 480]))
        come = rng.choice([None, start, start + dt.timedelta(minutes=rng.randrange(-20, 20))])
        go = rng.choice([None, end, end + dt.timedelta(seconds=rng.randrange(-900, 20000)), start - dt.timedelta(hours=1)])
        note = rng.choice(NOTES)
        rows.append((
            f"V{seed}-{k}", rng.choice(who[0] * 5 + who), "f", "a", None, rng.choice([None, start, start]), rng.choice([end, end, None]),
            come, go, None, None, "done", False, note, rng.choice([None, 0, len(note or ""), len(note or "")]),
        ))
    return spark.createDataFrame(rows, CARELOG)


@pytest.fixture
def people(rows):
    for who in "ABCDEFGH":
        rows.caregiver(who)
    return rows.visit("A").tables()[0]


def assert_equal(state, spark, warehouse, people, names=("overtime", "visit_duration"), limit=None):
    stored = read_table(spark, warehouse, "carelog")
    for name in names:
        told, wanted = state.report(name, people, limit=limit), FULL[name](people, stored, limit=limit)
        assert told.schema.simpleString() == wanted.schema.simpleString(), name
        assert told.collect() == wanted.collect(), name


def test_no_visits(spark, people):
    state = ReportState(spark, fresh_path(spark, "state")).sync()
    assert state.batches == []
    assert all(state.report(name, people, limit=None).count() == 0 for name in FULL)


def test_reports_equal_the_full_scan_after_every_load(spark, people):
    warehouse = fresh_path(spark, "state")
    for seed, (size, who) in enumerate([(150, "ABCDE"), (90, "AFGHX")]):
        append(visits(spark, seed, size, who), warehouse, "carelog")
        state = ReportState(spark, warehouse).sync()
        assert len(state.batches) == seed + 1
        assert_equal(state, spark, warehouse, people, FULL)
    assert_equal(state, spark, warehouse, people, limit=2)
    again = ReportState(spark, warehouse).sync()
    assert again.batches == state.batches


def test_reports_read_no_visits(spark, people):
    warehouse = fresh_path(spark, "state")
    append(visits(spark, 1, 50), warehouse, "carelog")
    state = ReportState(spark, warehouse).sync()
    for name in FULL:
        files = state.report(name, people).inputFiles()
        assert files and all("/report_state/" in f for f in files), name


def test_interrupted_sync_counts_nothing_twice(spark, people, monkeypatch):
    warehouse = fresh_path(spark, "state")
    append(visits(spark, 1, 80), warehouse, "carelog")
    broken = ReportState(spark, warehouse)
    monkeypatch.setattr(broken, "_cover", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        broken.sync()
    assert_equal(ReportState(spark, warehouse).sync(), spark, warehouse, people)


def test_batches_are_put_together(spark, people):
    warehouse = fresh_path(spark, "state")
    for seed in range(3):
        append(visits(spark, seed, 60), warehouse, "carelog")
        state = ReportState(spark, warehouse, most_batches=2).sync()
    assert len(state.batches) == 1 and state.generation == 1
    append(visits(spark, 9, 60), warehouse, "carelog")
    state = ReportState(spark, warehouse, most_batches=2).sync()
    assert len(state.batches) == 2
    assert_equal(state, spark, warehouse, people)


def test_a_rewritten_table_is_taken_in_anew(spark, people):
    warehouse = fresh_path(spark, "state")
    append(visits(spark, 1, 60), warehouse, "carelog")
    ReportState(spark, warehouse).sync()
    visits(spark, 2, 70).write.mode("overwrite").parquet(table_path(warehouse, "carelog"))
    assert_equal(ReportState(spark, warehouse).sync(), spark, warehouse, people)


def test_every_report_that_is_kept_is_tested():
    assert set(FULL) == {*report_state.REPORTS, "visit_duration"}


def test_reports_on_the_same_visits_share_a_part(spark, people):
    """Visits of a load are read and reduced once for each pair of reports, not once a report."""
    assert len(report_state.KEPT) == 6 < len(FULL)
    warehouse = fresh_path(spark, "state")
    append(visits(spark, 5, 300), warehouse, "carelog")
    state = ReportState(spark, warehouse).sync()
    assert_equal(state, spark, warehouse, people, ("comment_detail", "doc_suspicion", "overtime", "overtime_insight"))

"""What the plans look like: pruned scans, no cross products, no Python, bounded broadcasts."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_DIR, by_id
from visitlake.operators import admit
from visitlake.plans.abnormal import abnormal_visits
from visitlake.plans.duration import visit_duration
from visitlake.plans.overtime import overtime
from visitlake.plans.performance import top_performance
from visitlake.plans.reliability import reliability
from visitlake.sources import derived

# the training text operators are tested by themselves
OWN = [name for name in entry.queries() if not name.startswith("op") and name != "pipeline"]
REPORTS = sorted(name for name in OWN if name.startswith("report_") and not name.endswith("_all"))
TIME_REPORTS = [reliability, visit_duration, top_performance, abnormal_visits, overtime]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in OWN if not n.startswith(("source_", "ingest_stream", "load_"))))
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text
    if "BroadcastNestedLoopJoin" in text:
        # only the one-row statistics of the abnormal visits
        assert name in ("report_abnormal_visits", "report_abnormal_visits_all", "duration_stats")


@pytest.mark.parametrize("name", REPORTS)
def test_top_rows_are_not_fully_sorted(spark, name):
    assert "TakeOrderedAndProject" in plan(entry.queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("report", TIME_REPORTS)
def test_time_reports_never_read_the_notes(spark, report):
    frame = report(derived.caregivers(spark, SF_DIR), derived.carelogs(spark, SF_DIR))
    schemas = [part for part in plan(frame).split("ReadSchema: ")[1:]]
    assert schemas and not any("documentation" in part for part in schemas)


def test_filters_reach_the_scan(spark):
    text = plan(overtime(derived.caregivers(spark, SF_DIR), derived.carelogs(spark, SF_DIR)))
    assert "PushedFilters: [IsNotNull(clockInActualDatetime), IsNotNull(clockOutActualDatetime)" in text


def test_copies_are_cut_before_the_shuffle(spark):
    rows = spark.range(1000).select(
        F.concat(F.lit("hot"), (F.col("id") % 1).cast("string")).alias("caregiverId"), F.lit("f").alias("source_file"), F.lit(None).cast("timestamp").alias("modified"),
        F.lit(0).cast("long").alias("block_start"), F.col("id").alias("row_id"),
    )
    first = admit.first_rows(rows, ["caregiverId"])
    text = plan(first)
    assert "WindowGroupLimit" in text.split("Exchange")[-1]
    assert [r.row_id for r in first.collect()] == [0]


def test_busy_caregiver(spark, rows):
    """One caregiver holds most visits; results stay whole and equal to those of small input."""
    for i in range(40):
        rows.worked(f"C{i}", 100 + i, times=3, plan=90)
    caregivers, visits = rows.tables()
    busy = visits.where("caregiverId = 'C0'").crossJoin(spark.range(2000)).withColumn(
        "carelogId", F.concat("carelogId", F.lit("-"), F.col("id").cast("string"))
    ).drop("id")
    many = visits.where("caregiverId <> 'C0'").unionByName(busy)
    found = by_id(top_performance(caregivers, many))
    assert len(found) == 40 and found["C0"].actual_visits == 6000 and found["C0"].total_work_hours == 10000.0
    assert by_id(visit_duration(caregivers, many))["C0"].median_actual_duration_hours == 1.67
    assert by_id(overtime(caregivers, many))["C0"].overtime_visits == 6000


def test_abnormal_rows_of_one_caregiver_fill_the_report(spark, rows):
    for i in range(30):
        rows.worked("A", 100 + i % 3)
    for i in range(120):
        rows.worked("A", 2 + i % 7)
    rows.worked("B", 3)
    caregivers, visits = rows.tables()
    cut, full = abnormal_visits(caregivers, visits), abnormal_visits(caregivers, visits, limit=None)
    assert [r.carelogId for r in cut.collect()] == [r.carelogId for r in full.take(100)]
    assert full.count() == 121


@pytest.mark.parametrize(("report", "scans"), [(visit_duration, 2), (abnormal_visits, 3)])
@pytest.mark.parametrize("limit", [50, None])
def test_visits_are_read_few_times(spark, report, scans, limit):
    frame = report(derived.caregivers(spark, SF_DIR), derived.carelogs(spark, SF_DIR), limit)
    frame.collect()
    text = plan(frame).split("== Initial Plan ==")[0]
    read = [line for line in text.splitlines() if "FileScan parquet" in line and "clockInActualDatetime" in line]
    assert 1 <= len(read) <= scans
    assert not [line for line in text.splitlines() if "Window" in line and "carelogId" in line]

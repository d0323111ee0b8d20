"""How much is moved and written: compressed tables, files written once, wide rows shuffled no more than needed."""

import datetime as dt
import os

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from visitlake import load
from visitlake.schemas import CORRUPT, RAW_CARELOG
from visitlake.session import shared_dir
from visitlake.sources import derived, tables


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def folders(spark, name):
    home = shared_dir(spark)
    return {f for f in os.listdir(home) if f.startswith(name)}


def test_stored_tables_are_compressed_well(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").cast("string").alias("carelogId"))
    tables.append(rows, str(tmp_path), "some")
    written = [*derived.carelogs(spark, SF_DIR).inputFiles(), *tables.staged(rows, "few").inputFiles()]
    written += [f for f in os.listdir(tmp_path / "some") if f.endswith(".parquet")]
    assert written and all(f.endswith(".zstd.parquet") for f in written)


def test_mixed_files_are_written_once(spark):
    first = derived.mixed_files(spark, SF_DIR)
    before = {f.name: f.stat().st_mtime_ns for f in os.scandir(first) if f.name.endswith(".csv")}
    entry.queries()["source_validate"](spark, SF_DIR).collect()
    entry.queries()["load_batch"](spark, SF_DIR).count()
    assert entry._raw_files(spark, SF_DIR) == first
    assert before == {f.name: f.stat().st_mtime_ns for f in os.scandir(first) if f.name.endswith(".csv")}


def test_admission_does_not_shuffle_visits_for_a_few_unknown_ids(spark):
    for name in ("visit_admit", "visit_admit_indexed", "visit_orphans"):
        text = plan(entry.queries()[name](spark, SF_DIR))
        assert "SortMergeJoin [caregiverId" not in text and "BroadcastHashJoin [caregiverId" in text


def raw_visits(spark, ids):
    rows = [(k, "CG1") for k in ids]
    frame = spark.createDataFrame(rows, "carelog_id string, caregiver_id string")
    given = {"status": F.lit("F"), "start_datetime": F.lit("2024-01-05 10:00:00"), "end_datetime": F.lit("2024-01-05 11:00:00")}
    frame = frame.select("*", *[given.get(c, F.lit("x")).alias(c) for c in RAW_CARELOG if c not in frame.columns])
    return frame.select(
        "*", F.lit("carelog.csv").alias("source_file"), F.lit(dt.datetime(2024, 1, 1)).alias("modified"),
        F.lit(0).cast("long").alias("block_start"), F.monotonically_increasing_id().alias("row_id"), F.lit(None).cast("string").alias(CORRUPT),
    )


def known_caregiver(spark, warehouse):
    fields = tables.TABLES["caregiver"]
    row = {"caregiverId": "CG1", "applicant": False}
    values = tuple(row.get(f.name, "x" if f.dataType.typeName() == "string" else None) for f in fields)
    tables.append(spark.createDataFrame([values], fields), warehouse, "caregiver")


def test_new_visits_go_straight_into_the_table(spark, tmp_path):
    warehouse, staged_before = str(tmp_path), folders(spark, "new-carelog")
    known_caregiver(spark, warehouse)
    counts = load.load_carelogs(raw_visits(spark, ["V1", "V2", "V1"]), warehouse).first()
    assert (counts.processed_rows, counts.duplicate_rows) == (2, 1)
    assert sorted(r[0] for r in tables.read_table(spark, warehouse, "carelog").select("carelogId").collect()) == ["V1", "V2"]
    assert folders(spark, "new-carelog") == staged_before


def test_a_repeated_load_stores_visits_its_kept_counts_do_not_tell(spark, tmp_path):
    """The first attempt counted nothing as admitted, as the caregiver was unknown then; the repeat admits the visits."""
    warehouse = str(tmp_path)
    load.load_carelogs(raw_visits(spark, ["V1", "V2"]), warehouse, "one")
    known_caregiver(spark, warehouse)
    assert load.load_carelogs(raw_visits(spark, ["V1", "V2"]), warehouse, "one").first().processed_rows == 0
    assert tables.read_table(spark, warehouse, "carelog").count() == 2

"""Cleaning, admission, the load job and its incremental form."""

import datetime as dt
import itertools
import os

import pytest
from pyspark.sql import functions as F

from visitlake import load
from visitlake.functions import parsing
from visitlake.operators import metrics
from visitlake.operators.clean import CAREGIVER_RULES, MissingColumns, Rule, apply_rules
from visitlake.schemas import CORRUPT, ORIGIN, RAW_CAREGIVER, RAW_CARELOG
from visitlake.sources.tables import read_table
from visitlake.streaming.ingest import ingest, new_files, process_in_batches


CLOCK = itertools.count(1_700_000_000)


def parsed(spark, texts, rule):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in frame.orderBy("i").select(rule(F.col("t"))).collect()]


def test_flags(spark):
    assert parsed(spark, ["True", "true", "TRUE", "FALSE", "yes", "1", "", None, " true"], parsing.flag) == [
        True, True, True, False, False, False, False, False, False,
    ]


def test_numbers(spark):
    texts = ["12", " 7 ", "1e3", "abc", "", None, "0x10", "0b11", "0o17", "3.9", "-4", ".5", "1d", "NaN", "1,000", "99999999999"]
    assert parsed(spark, texts, parsing.whole_number) == [12, 7, 1000, 0, 0, 0, 16, 3, 15, 3, -4, 0, 0, 0, 0, 0]


def test_times(spark):
    texts = [
        "2024-01-05", "2024-01-05 10:20:30", "2024-01-05T10:20:30.123456Z", "2024-01-05T10:20:30+02:00", "1/5/2024",
        "01/05/2024 10:20", "1/5/2024 3:04:05 PM", "2024/1/5 10:20:30", "Jan 5, 2024", "January 5, 2024", "5 Jan 2024",
        "1/2/2024, 3:04:05 PM", "1/2/2024 3:04 pm", "Jan 5 2024", "5 January 2024", "Tue, 02 Jan 2024 10:00:00 GMT",
        "Mon Jan 01 2024 10:00:00", "01-02-2024", "January 5, 2024 10:00", "2024", "None", "", None, "not-a-date", "10:20", "2024-13-45", "13/45/2024",
    ]
    day = dt.datetime(2024, 1, 5)
    minute = day.replace(hour=10, minute=20)
    assert parsed(spark, texts, parsing.timestamp) == [
        day, minute.replace(second=30), minute.replace(second=30, microsecond=123000), minute.replace(hour=8, second=30),
        day, minute, day.replace(hour=15, minute=4, second=5), minute.replace(second=30), day, day, day,
        dt.datetime(2024, 1, 2, 15, 4, 5), dt.datetime(2024, 1, 2, 15, 4), day, day, dt.datetime(2024, 1, 2, 10),
        dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2), day.replace(hour=10), dt.datetime(2024, 1, 1), None, None, None, None, None, None, None,
    ]


def test_placeholder_addresses_repeat(spark):
    frame = spark.createDataFrame([("a", None), ("a", " \t"), ("b", ""), ("c", " x@y ")], "caregiver_id string, email string")
    found = [r[0] for r in frame.select(parsing.email(F.col("email"), F.col("caregiver_id"))).collect()]
    assert found[0] == found[1] != found[2] and found[3] == " x@y "
    assert all(f.startswith("no-email-") and f.endswith("@placeholder.com") for f in found[:3])


def test_rules_can_be_extended(spark):
    raw = spark.createDataFrame([("1", "x", 0, 0, None)], f"a string, source_file string, block_start long, row_id long, {CORRUPT} string").withColumn("modified", F.lit(None).cast("timestamp"))
    rules = [Rule("a", "A", lambda c: c.cast("int") + 1, True, "int"), Rule("b", "B")]
    assert apply_rules(raw, rules).select("A", "B").first() == (2, None)
    with pytest.raises(MissingColumns, match="c"):
        apply_rules(raw, [*rules, Rule("c", "C", required=True)])


def caregiver_line(who, name="Ann", **more):
    row = {
        "franchisor_id": "F1", "franchisor_name": "One", "agency_id": "A1", "agency_name": "Agency", "subdomain": "s",
        "profile_id": "p", "caregiver_id": who, "first_name": name, "last_name": "Lee", "applicant": "true",
        "locations_id": "L1", "location_name": "Site", "applicant_status": "hired", "status": "active",
    } | more
    return ",".join(row.get(c, "") for c in RAW_CAREGIVER)


def carelog_line(number, who, **more):
    row = {
        "franchisor_id": "F1", "agency_id": "A1", "carelog_id": number, "caregiver_id": who, "status": "done",
        "start_datetime": "2024-01-05 10:00:00", "end_datetime": "2024-01-05 11:00:00", "split": "false",
    } | more
    return ",".join(row.get(c, "") for c in RAW_CARELOG)


def write(folder, name, header, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([",".join(header), *lines]) + "\n")
    # the incremental load takes files in the order they were written
    moment = next(CLOCK)
    os.utime(folder / name, (moment, moment))


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    write(folder, "caregiver_1.csv", RAW_CAREGIVER, [
        caregiver_line("C1"), caregiver_line("C1", "Later"), caregiver_line("C2", franchisor_id="b-c", agency_id="a"),
        caregiver_line("C3", franchisor_id="c", agency_id="a-b"), caregiver_line(""), "F9,Nine",
    ])
    write(folder, "caregiver_2.csv", RAW_CAREGIVER, [
        caregiver_line("C2", "Later", franchisor_name="Other"), caregiver_line("C4", locations_id="") + ",surplus",
    ])
    write(folder, "carelog_1.csv", RAW_CARELOG, [
        # the first copy of V2 names an unknown caregiver, so the second is admitted
        carelog_line("V1", "C1"), carelog_line("V2", "nobody"), carelog_line("V2", "C2"), carelog_line("V2", "C3"),
        carelog_line("V3", "C9"), carelog_line("V1", "C2", status="copy"), carelog_line("", "C1"),
    ])
    write(folder, "readme.csv", ["x"], ["1"])
    return folder


def stored(spark, warehouse, name, *columns):
    return sorted(tuple(r) for r in read_table(spark, warehouse, name).select(*columns).collect())


def test_load_and_rerun(spark, inbox, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    counts = {r.source_file: r for r in load.run_load(spark, str(inbox), warehouse).collect()}
    shown = {n: (r.total_rows, r.processed_rows, r.failed_rows, r.orphan_rows, r.duplicate_rows) for n, r in counts.items()}
    assert shown == {"caregiver_1.csv": (6, 3, 2, 0, 1), "caregiver_2.csv": (2, 1, 0, 0, 1), "carelog_1.csv": (7, 2, 1, 2, 2)}
    caregivers = stored(spark, warehouse, "caregiver", "caregiverId", "firstName", "locationId")
    assert caregivers == [("C1", "Ann", "L1"), ("C2", "Ann", "L1"), ("C3", "Ann", "L1"), ("C4", "Ann", "")]
    assert stored(spark, warehouse, "carelog", "carelogId", "caregiverId") == [("V1", "C1"), ("V2", "C2")]
    # the short row still names a franchisor; two agencies whose joined ids look alike stay apart
    assert stored(spark, warehouse, "franchisor", "franchisorId", "name") == [
        ("F1", "One"), ("F9", "Nine"), ("b-c", "One"), ("c", "One"),
    ]
    assert stored(spark, warehouse, "agency", "agencyId", "franchisorId") == [("A1", "F1"), ("a", "b-c"), ("a-b", "c")]
    assert stored(spark, warehouse, "location", "locationId", "locationName") == [("L1", "Site")]

    repeated = load.run_load(spark, str(inbox), warehouse)
    again = metrics.totals(repeated, elapsed_ms=500).first()
    assert (again.total_rows, again.processed_rows, again.duplicate_rows) == (15, 0, 10)
    assert (again.success_rate, again.average_speed) == (0.0, 0.0)
    assert metrics.totals(repeated).first().elapsed_ms > 0
    assert stored(spark, warehouse, "caregiver", "caregiverId", "firstName", "locationId") == caregivers
    reasons = spark.read.parquet(f"{warehouse}/rejected_caregiver").select("reason").distinct().collect()
    assert {r[0] for r in reasons} == {"empty id", "fewer columns than the header"}


def test_waiting_visits_follow_their_caregiver(spark, inbox, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    load.run_load(spark, str(inbox), warehouse)
    assert load.retry_orphans(spark, warehouse) == 0
    assert load._waiting(spark, warehouse)[0].count() == 2
    late = tmp_path / "late"
    write(late, "caregiver_3.csv", RAW_CAREGIVER, [caregiver_line("C9")])
    load.run_load(spark, str(late), warehouse)
    assert ("V3", "C9") in stored(spark, warehouse, "carelog", "carelogId", "caregiverId")
    assert [r.caregiverId for r in load._waiting(spark, warehouse)[0].collect()] == ["nobody"]
    assert load.retry_orphans(spark, warehouse) == 0
    later = spark.read.parquet(f"{warehouse}/load_metrics/kind=orphan")
    assert [(r.source_file, r.admitted_later) for r in later.collect()] == [("carelog_1.csv", 1)]


def test_a_repeated_load_keeps_its_counts(spark, inbox, tmp_path):
    from visitlake.sources import csv_files

    warehouse = str(tmp_path / "warehouse")
    files = [f for f in csv_files.discover(spark, str(inbox)) if csv_files.kind_of(f.name) == "caregiver"]
    first = [load.load_caregivers(csv_files.read_files(spark, files), warehouse, "x").collect() for _ in range(2)]
    assert [sorted((r.source_file, r.processed_rows) for r in rows) for rows in first] == [[("caregiver_1.csv", 3), ("caregiver_2.csv", 1)]] * 2


def test_unreadable_times_are_counted(spark, tmp_path):
    write(tmp_path / "in", "caregiver.csv", RAW_CAREGIVER, [
        caregiver_line("C1", birthday_date="soon", onboarding_date="None"), caregiver_line("C2", birthday_date="5 Jan 2024", onboarding_date="32/1/2024"),
    ])
    counts = load.run_load(spark, str(tmp_path / "in"), str(tmp_path / "w")).first()
    assert (counts.processed_rows, counts.unreadable_times) == (2, 2)


def test_files_that_cannot_be_loaded_are_told_and_the_others_load(spark, tmp_path):
    write(tmp_path / "in", "caregiver_1.csv", [c for c in RAW_CAREGIVER if c != "profile_id"], [])
    write(tmp_path / "in", "caregiver_2.csv", RAW_CAREGIVER, [caregiver_line("C1")])
    (tmp_path / "in" / "caregiver_3.csv").write_bytes(b"\xff\xfe\x00c\n")
    (tmp_path / "in" / "carelog_1.csv").write_bytes(b"")
    counts = load.run_load(spark, str(tmp_path / "in"), str(tmp_path / "w")).collect()
    assert [r.source_file for r in counts] == ["caregiver_2.csv"] and counts[0].processed_rows == 1
    told = dict(map(tuple, spark.read.parquet(f"{tmp_path}/w/refused_file").collect()))
    assert told == {
        "caregiver_1.csv": "required columns not found: profile_id", "caregiver_3.csv": "not UTF-8 text", "carelog_1.csv": "no header",
    }
    with pytest.raises(FileNotFoundError):
        (tmp_path / "in" / "caregiver_2.csv").unlink()
        load.run_load(spark, str(tmp_path / "in"), str(tmp_path / "w"))
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        load.run_load(spark, str(tmp_path / "none"), str(tmp_path / "warehouse"))


def test_stream_takes_only_new_files(spark, inbox, tmp_path):
    warehouse, progress = str(tmp_path / "warehouse"), str(tmp_path / "progress")

    def run():
        ingest(spark, str(inbox), str(inbox), warehouse, progress, "caregiver*.csv", "carelog*.csv", files_per_batch=1)

    run()
    first = [stored(spark, warehouse, n, k) for n, k in (("caregiver", "caregiverId"), ("carelog", "carelogId"))]
    assert first == [[("C1",), ("C2",), ("C3",), ("C4",)], [("V1",), ("V2",)]]
    write(inbox, "caregiver_4.csv", RAW_CAREGIVER, [caregiver_line("C9"), caregiver_line("C1", "Again")])
    write(inbox, "carelog_2.csv", RAW_CARELOG, [carelog_line("V1", "C1"), carelog_line("V7", "C9")])
    run()
    run()
    assert stored(spark, warehouse, "caregiver", "caregiverId", "firstName") == [
        ("C1", "Ann"), ("C2", "Ann"), ("C3", "Ann"), ("C4", "Ann"), ("C9", "Ann"),
    ]
    # V3 waited for C9
    assert stored(spark, warehouse, "carelog", "carelogId") == [("V1",), ("V2",), ("V3",), ("V7",)]


def test_stream_sets_foreign_files_aside(spark, inbox, tmp_path):
    warehouse = str(tmp_path / "w")
    write(inbox, "caregiver_0.csv", ["x", "y"], ["1,2"])
    write(inbox, "caregiver_9.csv", list(reversed(RAW_CAREGIVER)), [",".join(reversed(caregiver_line("C8").split(",")))])
    ingest(spark, str(inbox), str(inbox), warehouse, str(tmp_path / "p"), "caregiver*.csv", "carelog*.csv")
    assert [r.source_file for r in spark.read.parquet(f"{warehouse}/refused_file").collect()] == ["caregiver_0.csv"]
    assert stored(spark, warehouse, "caregiver", "caregiverId")[-1] == ("C8",)


@pytest.mark.parametrize("size", [1, 2, 64])
def test_the_older_file_wins_whatever_the_batch_size(spark, tmp_path, size):
    folder = tmp_path / "in"
    write(folder, "caregiver_z.csv", RAW_CAREGIVER, [caregiver_line("C1", "Older")])
    write(folder, "caregiver_a.csv", RAW_CAREGIVER, [caregiver_line("C1", "Newer"), caregiver_line("C2")])
    write(folder, "carelog.csv", RAW_CARELOG, [carelog_line("V1", "C1")])
    ingest(spark, str(folder), str(folder), str(tmp_path / "w"), str(tmp_path / "p"), "caregiver*.csv", "carelog*.csv", size)
    assert stored(spark, str(tmp_path / "w"), "caregiver", "caregiverId", "firstName") == [("C1", "Older"), ("C2", "Ann")]
    load.run_load(spark, str(folder), str(tmp_path / "batch"))
    assert stored(spark, str(tmp_path / "batch"), "caregiver", "caregiverId", "firstName") == [("C1", "Older"), ("C2", "Ann")]


def test_callback_per_batch(spark, inbox, tmp_path):
    files = new_files(spark, str(inbox), "caregiver*.csv", files_per_batch=1)
    seen = {}
    for _ in range(2):
        run = lambda rows, load_id: seen.update({load_id: rows.count()})
        process_in_batches(files, run, str(tmp_path / "progress"), CAREGIVER_RULES)
    assert sorted(seen.values()) == [2, 6] and len({name.rsplit("-", 1)[0] for name in seen}) == 1


def test_stored_keys_are_reduced_before_they_are_compared(spark):
    from visitlake.operators import admit

    rows = spark.createDataFrame([("V1", "x")], "carelogId string, note string")
    plan = admit.not_stored(rows, spark.range(1000).selectExpr("cast(id as string) carelogId"), ["carelogId"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("LeftSemi")


def test_rule_list_covers_the_table():
    assert len(CAREGIVER_RULES) == 16 and ORIGIN == ["modified", "source_file", "block_start", "row_id"]

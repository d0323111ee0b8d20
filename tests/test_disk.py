"""What lies on disk while files are written, read and loaded, and behind that."""

import datetime as dt
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_volume import folders, known_caregiver, plan, raw_visits
from visitlake import load
from visitlake.operators import admit
from visitlake.schemas import RAW_CAREGIVER, RAW_CARELOG
from visitlake.session import SHUFFLE_CLEANUP, shared_dir
from visitlake.sources import csv_files, derived, tables
from visitlake.streaming import ingest

@pytest.fixture
def left(monkeypatch):
    """Folders staged in a test that are still there."""
    made, path = [], tables.fresh_path
    monkeypatch.setattr(tables, "fresh_path", lambda spark, name: made.append(path(spark, name)) or made[-1])

    def there():
        assert made
        return [f for f in made if os.path.exists(f.removeprefix("file:"))]

    return there


def star_tables(spark, folder):
    """A few workers, and visits whose keys fill nine files."""
    rows = {
        "nation": [(n, f"N{n}", n % 2) for n in range(4)],
        "customer": [(w, f"Customer {w}", w % 4, "BUILDING, or so") for w in range(120)],
        "orders": [(i * 3331, i % 120, "F", dt.datetime(2024, 1, 1) + dt.timedelta(days=i % 90), "1-URGENT") for i in range(400)],
        "documents": [(i, f'document {i}, "quoted"\nof two lines') for i in range(30)],
    }
    layouts = {
        "nation": "n_nationkey bigint, n_name string, n_regionkey bigint",
        "customer": "c_custkey bigint, c_name string, c_nationkey bigint, c_mktsegment string",
        "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
        "documents": "doc_id bigint, text string",
    }
    for name, layout in layouts.items():
        spark.createDataFrame(rows[name], layout).coalesce(2).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def contents(folder):
    return {f.name: Path(f.path).read_bytes() for f in os.scandir(folder) if f.name.endswith(".csv")}


def test_files_are_the_same_in_many_rounds_and_need_no_tables(spark, tmp_path, monkeypatch):
    where = star_tables(spark, tmp_path / "in")
    once = contents(derived.write_mixed_files(spark, where, str(tmp_path / "once")))
    monkeypatch.setattr(derived, "ROWS_PER_ROUND", 100)
    rounds = contents(derived.write_mixed_files(spark, where, str(tmp_path / "rounds")))
    assert len([n for n in once if n.startswith("carelog")]) == 9 and rounds == once
    assert not [key for key in derived._written if key[1] == where]
    # tables that some query has written are read
    monkeypatch.setattr(derived, "ROWS_PER_ROUND", 1000)
    derived.raw_carelogs(spark, where)
    assert contents(derived.write_mixed_files(spark, where, str(tmp_path / "stored"))) == once


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    rows = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("carelogId"))
    assert tables.staged(rows.repartition(3, "carelogId"), "few").count() == 2000
    tables.append(rows.repartition(3, "carelogId"), str(tmp_path), "some")
    for _ in range(50):  # they are removed in the background; the count above has a small one of its own
        written = [f for f in shuffle_files(spark) - before if f.endswith(".data")]
        if len({f.split("_")[1] for f in written}) <= 1:
            break
        time.sleep(0.2)
    assert len({f.split("_")[1] for f in written}) <= 1
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting


def test_only_writes_run_with_the_setting(spark, tmp_path, monkeypatch):
    """A frame made with it and read by and by would lose rows when its shuffle is removed."""
    settings, among = [], load.IdIndex.among
    monkeypatch.setattr(load.IdIndex, "among", lambda self, ids: settings.append(spark.conf.get(SHUFFLE_CLEANUP)) or among(self, ids))
    known_caregiver(spark, str(tmp_path))
    load.load_carelogs(raw_visits(spark, ["V1"]), str(tmp_path))
    assert settings and set(settings) == {"false"}


def test_texts_are_not_written_out_to_find_bad_rows(spark, tmp_path):
    notes = "".join(f'{i},"note {i}\nof {"x" * 200}"\n' for i in range(50))
    (tmp_path / "x.csv").write_text(f"id,note\n{notes}50\n51,a,b\n")
    before = folders(spark, "split-records")
    found = csv_files.bad_rows(spark, str(tmp_path), split_above=0)
    assert sorted(map(tuple, found.collect())) == [("x.csv", 51, "fewer values than columns"), ("x.csv", 52, "more values than columns")]
    (mine,) = folders(spark, "split-records") - before
    rows = spark.read.parquet(f"{shared_dir(spark)}/{mine}").where("__fragment is null").collect()
    assert len(rows) == 52 and not [r for r in rows if any("xxx" in str(v) for v in r)]


def test_any_column_names_in_blocks(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a b,"c;d",(e),__fragment,path,record\n1,"2\n3",4,5,6,7\n')
    for above in (0, 1000):
        rows = csv_files.read_files(spark, csv_files.discover(spark, str(tmp_path)), split_above=above)
        assert rows.columns[:6] == ["a b", "c;d", "(e)", "__fragment", "path", "record"]
        assert tuple(rows.first())[:6] == ("1", "2\n3", "4", "5", "6", "7")


@pytest.mark.parametrize("partition", [0, 3])
def test_bitmaps_tell_every_row(spark, partition):
    start = partition << 33
    rows = spark.range(start, start + 70_000).withColumnRenamed("id", admit.NUMBER)
    ends = F.col(admit.NUMBER).isin([start + k for k in (0, 1, 7, 8, 32_766, 32_767, 32_768, 32_769, 65_536, 69_999)])
    for chosen in (ends, ~ends, F.col(admit.NUMBER) % 7 == 3, F.lit(False)):
        want = rows.where(chosen)
        found = admit.marked(rows, admit.bits(want))
        assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()


def test_visits_do_not_move_to_be_admitted(spark, tmp_path, monkeypatch, left):
    plans, write = [], load._append
    monkeypatch.setattr(load, "_append", lambda rows, w, name, *more: (plans.append((name, plan(rows))), write(rows, w, name, *more)))
    warehouse = str(tmp_path)
    known_caregiver(spark, warehouse)
    counts = load.load_carelogs(raw_visits(spark, ["V1", "V2", "V1"]), warehouse).first()
    assert (counts.processed_rows, counts.duplicate_rows) == (2, 1)
    (text,) = [p for name, p in plans if name == "carelog"]
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text
    assert not left()


def test_one_of_two_rows_of_one_place_is_admitted(spark, tmp_path):
    warehouse = str(tmp_path)
    known_caregiver(spark, warehouse)
    rows = raw_visits(spark, ["V1", "V2"]).withColumn("row_id", F.lit(1).cast("long"))
    load.load_carelogs(rows.unionByName(rows), warehouse).collect()
    stored = tables.read_table(spark, warehouse, "carelog")
    assert sorted(r.carelogId for r in stored.collect()) == ["V1", "V2"]
    assert admit.NUMBER not in spark.read.parquet(f"{warehouse}/carelog").columns


def test_batches_leave_nothing_staged(spark, tmp_path, left):
    people, visits = ",".join(RAW_CAREGIVER), ",".join(RAW_CARELOG)
    (tmp_path / "in").mkdir()
    for k in range(3):
        person = {"caregiver_id": f"C{k}", "franchisor_id": "F", "agency_id": "A", "locations_id": "L"}
        (tmp_path / f"in/caregiver_{k}.csv").write_text(f"{people}\n{','.join(person.get(c, 'x') for c in RAW_CAREGIVER)}\n")
        rows = [{"carelog_id": f"{kind}{k}", "caregiver_id": who} for kind, who in (("V", f"C{k}"), ("W", "none"))]
        (tmp_path / f"in/carelog_{k}.csv").write_text("\n".join([visits, *[",".join(r.get(c, "x") for c in RAW_CARELOG) for r in rows]]))
    folder, warehouse = str(tmp_path / "in"), str(tmp_path / "warehouse")
    ingest.ingest(spark, folder, folder, warehouse, str(tmp_path / "progress"), "caregiver*.csv", "carelog*.csv", files_per_batch=1)
    assert sorted(r.carelogId for r in tables.read_table(spark, warehouse, "carelog").collect()) == ["V0", "V1", "V2"]
    assert not left()


def test_staged_rows_of_a_failed_load_are_removed(spark, tmp_path, monkeypatch, left):
    monkeypatch.setattr(load, "_report", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        load.load_carelogs(raw_visits(spark, ["V1"]), str(tmp_path))
    assert not left()

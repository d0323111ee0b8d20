"""CSV folders: odd rows, quoting, headers, files larger than one task reads."""

import csv
import random

import pytest

from visitlake.schemas import CORRUPT, ORIGIN
from visitlake.sources import csv_files


@pytest.fixture
def folder(tmp_path):
    def write(**files):
        for name, content in files.items():
            (tmp_path / f"{name}.csv").write_bytes(content.encode())
        return str(tmp_path)

    return write


def read(spark, path, **more):
    return csv_files.read_files(spark, csv_files.discover(spark, path), **more)


def values(frame, *columns):
    return [tuple(r) for r in frame.orderBy(*ORIGIN).select(*columns).collect()]


def test_quotes_and_line_breaks(spark, folder):
    path = folder(x='a,b\n1,"say ""hi"", twice"\n2,"two\nlines"\n\n3,\n')
    assert values(read(spark, path), "a", "b") == [("1", 'say "hi", twice'), ("2", "two\nlines"), ("3", None)]


def test_short_rows_are_marked_and_long_rows_kept(spark, folder):
    path = folder(x='a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x,y","p ""q""",z\n')
    assert values(read(spark, path), "a", "c", CORRUPT) == [
        ("1", "3", None), ("4", None, "4,5"), ("6", "8", None), ("x,y", "z", None),
    ]
    assert [c for (c,) in values(read(spark, path, keep_ragged=True), CORRUPT)] == [None, "4,5", "6,7,8,9", None]


def test_each_file_has_its_own_header(spark, folder):
    path = folder(one="a,b\n1,2\n", two="﻿b,c,a\n3,4,5\n", three="a,b\n", four="")
    assert values(read(spark, path), "a", "b", "c") == [("1", "2", None), ("5", "3", "4")]
    assert [f.name for f in csv_files.discover(spark, path)] == ["four.csv", "one.csv", "three.csv", "two.csv"]


def test_last_of_two_equal_columns_counts(spark, folder):
    path = folder(x="a,b,a\n1,2,3\n")
    assert values(read(spark, path), "a", "b") == [("3", "2")]


def test_validate(spark, folder):
    path = folder(good="a,b\n1,2\n", ragged="a,b\n1\n1,2,3\n1,2\n", twice="a,a\n1,2\n", empty="a,b\n", nothing="")
    found = {r.source_file: r for r in csv_files.validate(spark, path).collect()}
    assert {n: (r.row_count, r.inconsistent_rows, r.duplicate_columns, r.is_valid) for n, r in found.items()} == {
        "good.csv": (1, 0, "", True), "ragged.csv": (3, 2, "", False), "twice.csv": (1, 0, "a", False),
        "empty.csv": (0, 0, "", True), "nothing.csv": (0, 0, "", False),
    }


def test_profile_preview_headers(spark, folder):
    path = folder(x="a,b\n1,2\n333,4\n" + "5,6\n" * 10)
    row = csv_files.profile(spark, path).first()
    assert (row.file_size, row.row_count, row.column_count, row.headers) == (54, 12, 2, "a,b")
    assert (row.shortest_row, row.longest_row) == (2, 4)
    assert csv_files.headers(spark, f"{path}/x.csv") == ["a", "b"]
    assert values_of_preview(spark, f"{path}/x.csv") == [("1", "2"), ("333", "4"), ("5", "6")]


def values_of_preview(spark, path):
    return [tuple(r) for r in csv_files.preview(spark, path, 3).collect()]


def test_routing():
    names = ["Caregiver_Data.csv", "my_carelog.CSV", "notes.csv", "caregiver_carelog.csv"]
    assert [csv_files.kind_of(n) for n in names] == ["caregiver", "carelog", None, "caregiver"]


def odd_table():
    random.seed(5)
    words = ["plain", "with, comma", 'with "quotes"', "", "line\nbreak", "\n\n", 'x\r\ny"\n']
    return [(str(i), random.choice(words), "".join(random.choices("abc", k=random.randint(0, 90)))) for i in range(300)]


def test_rows_do_not_depend_on_the_split_size(spark, tmp_path):
    """Stray quotes, quoted line breaks, CRLF, short and long rows, under two split sizes."""
    with open(tmp_path / "quoted.csv", "w", newline="") as f:
        csv.writer(f).writerows([("id", "note", "tail"), *odd_table()])
    stray = "id,note,tail\n" + "".join(f'{i},walked {i}" with cane,end\n' for i in range(40)) + "40,short\n41,a,b,c\n"
    (tmp_path / "stray.csv").write_text(stray)
    (tmp_path / "crlf.csv").write_bytes(b'id,note,tail\r\n1,"a\r\nb",x\r\n2,c,d\r\n')
    found = {}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128m", "300b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found[size] = values(read(spark, str(tmp_path)), "source_file", "id", "note", "tail", CORRUPT)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found["128m"] == found["300b"]
    assert sum(r[0] == "stray.csv" for r in found["128m"]) == 42
    assert [(r[1], r[2] or "", r[3] or "") for r in found["128m"] if r[0] == "quoted.csv"] == [
        (a, b.replace("\r\n", "\n"), c) for a, b, c in odd_table()
    ]


def test_files_without_line_breaks_may_be_split(spark, tmp_path):
    """The caller's word for it gives the same rows, from many tasks."""
    lines = "id,note,tail\n" + "".join(f'{i},"say ""{i}"", twice",{"x" * (i % 50)}\n' for i in range(300))
    (tmp_path / "plain.csv").write_text(lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    try:
        split = read(spark, str(tmp_path), multi_line=False)
        assert split.rdd.getNumPartitions() > 4
        assert values(split, "id", "note", "tail") == values(read(spark, str(tmp_path)), "id", "note", "tail")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bad_rows_have_places(spark, folder):
    path = folder(x="a,b\n1,2\n3\n4,5\n6,7,8\n", y="a\n1\n")
    found = sorted(tuple(r) for r in csv_files.bad_rows(spark, path).collect())
    assert found == [("x.csv", 2, "fewer values than columns"), ("x.csv", 4, "more values than columns")]

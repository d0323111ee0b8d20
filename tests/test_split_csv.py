"""Files with quoted line breaks, cut into blocks: the same rows and row numbers as read whole."""

import random

import pytest
from pyspark.sql import functions as F

from visitlake.sources import csv_files, split_csv

WHOLE = 'a,b,c\n1,"two\nlines","x ""y""\n\n,z"\n2,plain,5" pipe\n\n3,short\n4,"",long,er\n"5","a,b\n"",""c",d\n6,q"uo\n7,"e\n\n\n\n\nf",g'


def rows_of(spark, folder, split_above):
    rows = csv_files.read_files(spark, csv_files.discover(spark, folder), keep_ragged=True, split_above=split_above)
    found = csv_files.numbered(rows, F.lit(True)).select("source_file", "row_number", "a", "b", "c", csv_files.CORRUPT)
    return sorted(map(tuple, found.collect()), key=lambda r: (r[0], r[1]))


@pytest.fixture
def block(spark):
    """Sets the size of Spark's blocks for a test."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.set(name, before)


def test_cut_at_every_offset(spark, tmp_path, block):
    """A file of every length before another: each block size cuts it elsewhere."""
    (tmp_path / "x.csv").write_text(WHOLE)
    (tmp_path / "y.csv").write_text(WHOLE.replace("\n", "\r\n"))
    block(128 * 1024 * 1024)
    want = rows_of(spark, str(tmp_path), 1 << 40)
    assert len(want) == 14 and any("\n\n" in (r[4] or "") for r in want)
    for size in [7, 24, 41]:
        block(size)
        assert rows_of(spark, str(tmp_path), 0) == want, size


def test_random_files(spark, tmp_path, block):
    draw = random.Random(11)
    for number in range(6):
        value = lambda: "".join(draw.choice('xy ,\n""') for _ in range(draw.randint(0, 9)))
        quoted = lambda v: '"' + v.replace('"', '""') + '"' if draw.random() < 0.8 or any(c in v for c in ',\n"') else v
        lines = [",".join(quoted(value()) for _ in range(draw.choice([3, 3, 3, 2, 4]))) for _ in range(40)]
        (tmp_path / f"f{number}.csv").write_text("a,b,c\n" + "\n".join(lines) + draw.choice(["", "\n"]))
    block(128 * 1024 * 1024)
    want = rows_of(spark, str(tmp_path), 1 << 40)
    for size in (23, 60):
        block(size)
        assert rows_of(spark, str(tmp_path), 0) == want


def test_how_blocks_begin(spark):
    """Blocks that end alike, leave things as they are, or turn them round, by hand."""
    kinds = {"same": (False, True), "turn": (True, False), "in": (True, True), "out": (False, False)}
    draw = random.Random(4)
    made, want = [], set()
    for path in "abc":
        inside = False
        for start in range(40):
            if inside:
                want.add((path, start))
            kind = kinds[draw.choice(["same", "same", "turn", "turn", "in", "out"])]
            made.append((path, start, *kind))
            inside = kind[inside]
    draw.shuffle(made)
    effects = spark.createDataFrame(made, "path string, block_start bigint, if_outside boolean, if_inside boolean")
    assert {tuple(r) for r in split_csv.begun_inside(effects).collect()} == want


@pytest.mark.parametrize(
    ("line", "outside", "inside"),
    [("", False, True), ('"', True, False), ('a"b', False, False), ('x,"y', True, True), ('"",', False, True), ('a","b', True, False), ('""",', True, False)],
)
def test_ends_of_lines(line, outside, inside):
    assert split_csv.ends_inside(line, False) is outside
    if line not in ('x,"y', 'a","b', '""",', '"",', 'a"b'):
        assert split_csv.ends_inside(line, True) is inside


def test_many_tasks_read_one_file(spark, tmp_path, block):
    (tmp_path / "x.csv").write_text("a,b,c\n" + '1,"two\nlines",3\n' * 5000)
    block(10_000)
    frame = csv_files.read_files(spark, csv_files.discover(spark, str(tmp_path)), split_above=10_000)
    assert frame.select("block_start").distinct().count() >= 8
    assert frame.where("b = 'two\\nlines' and c = '3'").count() == 5000

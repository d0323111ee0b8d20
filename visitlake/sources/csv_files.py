"""Raw CSV folders: discovery, reading, preview, validation, profile.

Every file is read by its own header, so column order may differ between files.
Values stay text. Quotes are doubled inside quoted values, and a quoted value may
contain line breaks.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlake.schemas import CORRUPT, ORIGIN
from visitlake.session import importable, prepare
from visitlake.sources import heads, split_csv

CSV_NAMES = "*.[cC][sS][vV]"
#: Bytes of a file that one task reads, at most.
SPLIT_ABOVE = 256 * 1024 * 1024
OPTIONS = {
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    # rows of the wrong length are recognised even if few columns are selected
    "columnPruning": "false",
}


@dataclass(frozen=True)
class CsvFile:
    path: str
    size: int
    header: tuple[str, ...]
    modified: dt.datetime | None = None
    reason: str | None = None

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]

    @property
    def duplicated_columns(self) -> tuple[str, ...]:
        return tuple(sorted({c for c in self.header if self.header.count(c) > 1}))


def kind_of(name: str) -> str | None:
    """Which table a file belongs to, by its name; None for neither."""
    lowered = name.lower()
    return next((kind for kind in ("caregiver", "carelog") if kind in lowered), None)


def discover(spark: SparkSession, folder: str) -> list[CsvFile]:
    """The CSV files directly in a folder, by name, with sizes and headers.

    One job lists names and lengths and opens each file for its first record. Spark's
    reader holds the list of files on the driver anyway.
    """
    return described(prepare(spark), folder)


def described(spark: SparkSession, paths: str | list[str]) -> list[CsvFile]:
    """The CSV files of a folder, or those named one by one. What is wrong with a file is its ``reason``."""
    reader = importable(spark).read.format("binaryFile").option("pathGlobFilter", CSV_NAMES)
    listing = reader.load(paths).select("path", "length", "modificationTime")
    known = {_name(r["path"]): r for r in heads.heads(listing).toLocalIterator()}
    unopened = [r["path"] for r in known.values() if r["head"] is None and r["reason"] is None]
    first = _first_lines(spark, unopened) if unopened else {}
    files = {
        name: CsvFile(r["path"], r["length"], heads.columns_of(r["head"] or first.get(name)), r["modificationTime"], r["reason"])
        for name, r in known.items()
    }
    # a file without a byte is listed, but gives no row to any reader
    for path in reader.load(paths).inputFiles():
        files.setdefault(_name(path), CsvFile(unquote(path), 0, (), None, heads.NO_HEADER))
    return [files[n] for n in sorted(files)]


def _first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """First lines of files that only Spark can open; it reads the whole files for that."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    first = (
        lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
        .where("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    )
    return {_name(r["file"]): r["header"] for r in first.toLocalIterator()}


def _name(path: str) -> str:
    return unquote(path).rsplit("/", 1)[-1]


def _schema(header: tuple[str, ...]) -> T.StructType:
    names = [f"c{i}" for i in range(len(header))]
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])


def _read_plain(spark: SparkSession, files: list[CsvFile], multi_line: bool) -> DataFrame:
    reader = spark.read.schema(_schema(files[0].header)).options(**OPTIONS)
    rows = reader.option("header", True).option("multiLine", multi_line).csv([f.path for f in files])
    return rows.select(
        "*",
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
    )


def _read_split(spark: SparkSession, files: list[CsvFile], kept: list[tuple[str, Column]]) -> DataFrame:
    """The same rows as ``_read_plain``, of which ``kept`` is made, by tasks that each read a block of a file."""
    layout = ", ".join(f"{f.name} string" for f in _schema(files[0].header))
    parsed = F.from_csv("record", layout, {**OPTIONS, "multiLine": "true"})

    def wanted(records: DataFrame) -> DataFrame:
        # they are written out, and a header may hold names that a table cannot
        numbered_names = [c.alias(f"v{i}") for i, (_, c) in enumerate(kept)]
        others = [c for c in records.columns if c == split_csv.FRAGMENT]
        return records.withColumn("parsed", parsed).select("*", "parsed.*").select(*numbered_names, *others)

    return split_csv.records(spark, [f.path for f in files], wanted).toDF(*[name for name, _ in kept])


def too_long(corrupt: Column, width: int | Column) -> Column:
    """Whether a row of the wrong length has more values than the header."""
    bare = F.regexp_replace(corrupt, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) >= width


def read_files(
    spark: SparkSession, files: list[CsvFile], keep_ragged: bool = False, multi_line: bool = True, split_above: int = SPLIT_ABOVE,
    made: Callable[[dict[str, Column]], dict[str, Column]] = dict,
) -> DataFrame:
    """Rows of the files as text, with the place each came from.

    Quoted values may hold line breaks, so that a file of up to ``split_above`` bytes is
    read by one task, and a larger one block by block, see ``split_csv``. A caller who
    knows that no value does may say ``multi_line=False``, and Spark's reader splits
    large files itself. The rows are the same in all cases. A row with too many values is kept and the
    surplus ignored; one with too few has ``_corrupt_record`` set. ``keep_ragged``
    marks both, for validation. Columns absent from a file are NULL in its rows.
    ``made`` makes of a file's columns what is needed beside the place and the mark of a
    row; the rest is not written where rows are read block by block.
    """
    prepare(spark)
    groups: dict[tuple, list[CsvFile]] = defaultdict(list)
    for f in files:
        if f.header and not f.reason:
            groups[f.header, multi_line and f.size > split_above].append(f)
    parts = []
    for (header, large), members in groups.items():
        # of two columns with one name the last counts
        place = {name: F.col(f"c{i}") for i, name in enumerate(header)}
        bad = F.col(CORRUPT) if keep_ragged else F.when(~too_long(F.col(CORRUPT), len(header)), F.col(CORRUPT))
        # Spark refuses to read this column alone; the second branch, never taken, names another
        corrupt = F.when(F.col(CORRUPT).isNotNull(), bad).when(F.length("c0") < 0, F.col("c0"))
        kept = [*made(place).items(), *[(c, F.col(c)) for c in ORIGIN], (CORRUPT, corrupt)]
        parts.append(
            _read_split(spark, members, kept) if large
            else _read_plain(spark, members, multi_line).select(*[c.alias(n) for n, c in kept])
        )
    if not parts:
        raise FileNotFoundError("no CSV file with a header")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def preview(spark: SparkSession, path: str, rows: int = 5) -> DataFrame:
    """The first rows of a file, which the reader hands out in file order."""
    return read_files(spark, discover(spark, path)).limit(rows).drop(*ORIGIN, CORRUPT)


def headers(spark: SparkSession, path: str) -> list[str]:
    """Column names of a file."""
    return list(discover(spark, path)[0].header)


def numbered(rows: DataFrame, chosen: Column) -> DataFrame:
    """The ``chosen`` rows with ``row_number``, their place among the rows of their file, from 1.

    Row ids count up inside a block. So a row's place is its distance to the first id of
    its block, and the rows of earlier blocks, counted once per block.
    """
    block = ["source_file", "block_start"]
    blocks = rows.groupBy(*block).agg(F.min("row_id").alias("first_id"), F.count("*").alias("block_rows"))
    before = Window.partitionBy("source_file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("rows_before", F.coalesce(F.sum("block_rows").over(before), F.lit(0)))
    place = F.col("row_id") - F.col("first_id") + F.col("rows_before") + 1
    return rows.where(chosen).join(blocks, block).withColumn("row_number", place).drop("first_id", "block_rows", "rows_before")


def bad_rows(spark: SparkSession, folder: str, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Rows whose length differs from the header: file, place in the file, what is wrong."""
    files = discover(spark, folder)
    rows = read_files(spark, files, keep_ragged=True, split_above=split_above, made=_nothing)
    rows = numbered(rows, F.col(CORRUPT).isNotNull())
    rows = rows.join(_described(spark, files).select("source_file", "column_count"), "source_file")
    longer = too_long(F.col(CORRUPT), F.col("column_count"))
    return rows.select("source_file", "row_number", F.when(longer, "more values than columns").otherwise("fewer values than columns").alias("problem"))


def _nothing(columns: dict[str, Column]) -> dict[str, Column]:
    """For reports that only look at the place and the mark of a row."""
    return {}


def _described(spark: SparkSession, files: list[CsvFile]) -> DataFrame:
    """What is known of the files without reading their rows."""
    facts = [
        (f.name, f.size, len(f.header), ",".join(f.header), ",".join(f.duplicated_columns)) for f in files
    ]
    return spark.createDataFrame(
        facts, "source_file string, file_size bigint, column_count int, headers string, duplicate_columns string"
    )


def profile(spark: SparkSession, folder: str) -> DataFrame:
    """Per file: size, exact row count, headers, shortest and longest row in characters."""
    files = discover(spark, folder)
    width = lambda columns: {"width": F.length(F.concat_ws("", *columns.values())).cast("bigint")}
    counted = read_files(spark, files, made=width).groupBy("source_file").agg(
        F.count("*").alias("row_count"), F.min("width").alias("shortest_row"), F.max("width").alias("longest_row")
    )
    told = _described(spark, files).drop("duplicate_columns").join(counted, "source_file", "left")
    return told.withColumn("row_count", F.coalesce("row_count", F.lit(0)))


def validate(spark: SparkSession, folder: str) -> DataFrame:
    """Per file: rows, rows whose length differs from the header, repeated column names, verdict."""
    files = discover(spark, folder)
    counted = read_files(spark, files, keep_ragged=True, made=_nothing).groupBy("source_file").agg(
        F.count("*").alias("row_count"), F.count_if(F.col(CORRUPT).isNotNull()).alias("inconsistent_rows")
    )
    checked = _described(spark, files).drop("file_size", "column_count").join(counted, "source_file", "left")
    checked = checked.fillna(0, ["row_count", "inconsistent_rows"])
    return checked.withColumn("is_valid", (F.col("inconsistent_rows") == 0) & (F.col("duplicate_columns") == "") & (F.col("headers") != ""))

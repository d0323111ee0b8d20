"""Large CSV files whose quoted values may hold line breaks, read by many tasks.

Spark's text reader cuts a file into blocks at line breaks, wherever they stand. A first
scan tells for every block whether it would end inside quotes, both if it began outside
and if it began inside. Put together in the order of the blocks, that gives how each one
truly begins. A second scan joins lines to records. What a block holds of a record that
began before it, and of one that does not end in it, is a fragment; the few fragments
are put together at the end.

A quote opens a value only at its beginning, and in an open value two quotes stand for
one, as in Spark's own reader. A block that begins inside quotes is the only thing the
driver learns of, one small entry each.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlake.session import importable
from visitlake.sources.tables import staged

#: What a row of the second scan is: a whole record, the end of one, the beginning of one.
WHOLE, END, BEGINNING = 0, 1, 2
ROWS_PER_BATCH = 5_000
BLOCK = ["path", "block_start"]
#: The column that holds a fragment beside what is kept of whole records.
FRAGMENT = "__fragment"

_OPENS = re.compile('(?:^|,)"')
_CLOSES = re.compile('(?:[^"]|"")*+"')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a value is open behind a line, if one is (not) before it."""
    place = 0
    while True:
        if inside:
            closed = _CLOSES.match(line, place)
            if not closed:
                return True
            place = closed.end()
        opened = _OPENS.search(line, place)
        if not opened:
            return False
        place, inside = opened.end(), True


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    rows = importable(spark).read.option("lineSep", "\n").text(paths)
    return rows.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block_start"), "value",
        F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_modification_time").alias("modified"),
    )


def block_effects(lines: DataFrame) -> DataFrame:
    """Per block: whether it ends inside quotes, if it begins outside, and if it begins inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, state = None, [False, True]
        told: list[tuple] = []

        def shown() -> pa.RecordBatch:
            columns = zip(*told, strict=True)
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*BLOCK, "if_outside", "if_inside"])

        for batch in batches:
            for path, start, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (path, start) != block:
                    if block:
                        told.append((*block, *state))
                    block, state = (path, start), [False, True]
                if '"' in line:
                    state = [ends_inside(line, s) for s in state]
        if block:
            told.append((*block, *state))
        if told:
            yield shown()

    return lines.select(*BLOCK, "value").mapInArrow(run, "path string, block_start bigint, if_outside boolean, if_inside boolean")


def begun_inside(effects: DataFrame) -> DataFrame:
    """Blocks that begin inside quotes: what precedes them in their file, put together.

    A block either ends alike however it begins, or leaves things as they are, or turns
    them round. So the last block of the first kind and the number of turns since tell.
    """
    earlier = Window.partitionBy("path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    until = Window.partitionBy("path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, 0)
    turns = F.sum((F.col("if_outside") & ~F.col("if_inside")).cast("int"))
    fixed = F.col("if_outside") == F.col("if_inside")
    counted = effects.withColumns({"turned": F.coalesce(turns.over(earlier), F.lit(0)), "turned_too": turns.over(until)})
    sure = F.last(F.when(fixed, F.struct(F.col("if_outside").alias("value"), F.col("turned_too").alias("turned"))), ignorenulls=True)
    told = counted.withColumn("sure", sure.over(earlier))
    since = F.col("turned") - F.coalesce("sure.turned", F.lit(0))
    inside = F.coalesce("sure.value", F.lit(False)) != (since % 2 == 1)
    return told.where(inside).select(*BLOCK)


def _tidy(record: Column) -> Column:
    """A line break may be written as two characters, which Spark's reader makes one."""
    return F.regexp_replace(record, r"\r(?=\n)|\r\z", "")


def records(spark: SparkSession, paths: list[str], kept: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Records of the files but for their headers, as text, with ``row_id``, their place among those of their block.

    A record belongs to the block in which it begins. Blank lines are no records. The
    records are written out once; ``kept`` makes of their columns, row by row, those that the
    caller needs, and only these are written. It leaves other columns in place.
    """
    lines = _lines(spark, paths)
    inside_at = {(r["path"], r["block_start"]) for r in begun_inside(block_effects(lines)).toLocalIterator()}
    names = [*BLOCK, "source_file", "modified", "row_id", "kind", "record"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        block: tuple | None = None
        held: list[str] = []
        inside, kind, place = False, WHOLE, 0

        def put(what: int) -> None:
            nonlocal place
            text = "\n".join(held)
            held.clear()
            if what == WHOLE and text in ("", "\r"):
                return
            made.append((*block, place, what, text))
            place += what != END

        def shown() -> pa.RecordBatch:
            rows, types = list(zip(*made, strict=True)), [*batch.schema.types[:2], *batch.schema.types[3:], pa.int64(), pa.int32(), pa.string()]
            made.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names)

        for batch in batches:
            paths, starts, values, files, times = (batch.column(k) for k in range(5))
            for row in zip(paths.to_pylist(), starts.to_pylist(), files.to_pylist(), times.to_pylist(), values.to_pylist(), strict=True):
                *place_of, line = row
                if block is None or place_of[:2] != list(block[:2]):
                    if held:
                        put(BEGINNING if kind == WHOLE else END)
                    block, place = tuple(place_of), 0
                    inside = (block[0], block[1]) in inside_at
                    kind = END if inside else WHOLE
                held.append(line)
                if '"' in line:
                    inside = ends_inside(line, inside)
                if not inside:
                    put(kind)
                    kind = WHOLE
                if len(made) >= ROWS_PER_BATCH:
                    yield shown()
        if held:
            put(BEGINNING if kind == WHOLE else END)
        if made:
            yield shown()

    layout = "path string, block_start bigint, source_file string, modified timestamp, row_id bigint, kind int, record string"
    found = lines.mapInArrow(run, layout)
    header = (F.col("block_start") == 0) & (F.col("row_id") == 0)
    # a fragment keeps its text; of a whole record the text goes on only if it is kept
    fragment = F.when(F.col("kind") != WHOLE, F.struct("path", "block_start", "source_file", "modified", "row_id", "kind", "record"))
    found = found.where((F.col("kind") != WHOLE) | ~header).withColumn(FRAGMENT, fragment).drop("kind")
    found = staged(kept(found.withColumn("record", _tidy(F.col("record")))), "split-records")
    whole = found.where(F.col(FRAGMENT).isNull()).drop(FRAGMENT)
    parts = found.where(F.col(FRAGMENT).isNotNull()).select(f"{FRAGMENT}.*")
    number = F.sum((F.col("kind") == BEGINNING).cast("int")).over(Window.partitionBy("path").orderBy("block_start", "kind"))
    part = F.struct("block_start", "kind", "row_id", "record", "source_file", "modified")
    joined = parts.withColumn("number", number).groupBy("path", "number").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    first = F.col("parts")[0]
    stitched = joined.select(
        "path", first["block_start"].alias("block_start"), first["source_file"].alias("source_file"), first["modified"].alias("modified"),
        first["row_id"].alias("row_id"), _tidy(F.array_join(F.transform("parts", lambda p: p["record"]), "\n")).alias("record"),
    )
    return whole.unionByName(kept(stitched.where(~header)))

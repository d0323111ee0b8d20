"""Incremental load: new files of a folder are processed once, in small batches.

A stream finds the files; each micro-batch reads its files with the reader of the
batch load, by their own headers, and takes the same steps. Duplicates are found
against the stored tables, so the stream itself keeps no state beyond the list of files
already seen. Files are taken in the order of their modification times, and of two
copies of an id the one in the older file wins, whatever the size of a batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from visitlake.load import load_caregivers, load_carelogs, refusal, retry_orphans
from visitlake.load import refuse as store_refused
from visitlake.operators.clean import CAREGIVER_RULES, CARELOG_RULES, Rule
from visitlake.session import prepare
from visitlake.sources import csv_files
from visitlake.sources.csv_files import CSV_NAMES
from visitlake.sources.tables import scratch

FILES_PER_BATCH = 64


def new_files(spark: SparkSession, folder: str, names: str = CSV_NAMES, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """A stream of new files: path, length and modification time. Their contents are not read."""
    layout = "path string, modificationTime timestamp, length bigint, content binary"
    reader = prepare(spark).readStream.format("binaryFile").schema(layout).option("pathGlobFilter", names)
    return reader.option("maxFilesPerTrigger", files_per_batch).load(folder).select("path", "length", "modificationTime")


def process_in_batches(
    files: DataFrame, on_batch: Callable[[DataFrame, str], None], checkpoint: str,
    rules: list[Rule], multi_line: bool = True, refuse: Callable[[list[tuple[str, str]]], None] | None = None,
) -> StreamingQuery:
    """Hand the rows of what has arrived to ``on_batch`` in micro-batches, each with an id, and return when done.

    A batch interrupted by a failure comes again with the same rows and id; the id names
    the stream, too, so that another stream's batches have others. Files that cannot be
    loaded are handed to ``refuse`` (file and reason), and the others go on. The rows are
    good for the batch only: what was staged for them is removed behind it.
    """

    def one(found: DataFrame, number: int) -> None:
        spark = found.sparkSession
        paths = [r["path"] for r in found.select("path").toLocalIterator()]  # a batch's files
        if not paths:
            return
        told = csv_files.described(spark, paths)
        reasons = {f.name: refusal(f, rules) for f in told}
        bad = [(name, reason) for name, reason in reasons.items() if reason]
        if bad and refuse:
            refuse(bad)
        good = [f for f in told if not reasons[f.name]]
        if good:
            stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
            with scratch(spark):
                on_batch(csv_files.read_files(spark, good, multi_line=multi_line), f"{stream}-{number}")

    query = files.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ingest(
    spark: SparkSession,
    caregiver_folder: str,
    carelog_folder: str,
    warehouse: str,
    checkpoint: str,
    caregiver_names: str = CSV_NAMES,
    carelog_names: str = CSV_NAMES,
    files_per_batch: int = FILES_PER_BATCH,
    multi_line: bool = True,
) -> None:
    """Process what has arrived since the last call: all caregivers, then all visits, then waiting visits."""

    def refuse(found: list[tuple[str, str]]) -> None:
        store_refused(spark, found, warehouse)

    for kind, folder, names, rules, load in (
        ("caregiver", caregiver_folder, caregiver_names, CAREGIVER_RULES, load_caregivers),
        ("carelog", carelog_folder, carelog_names, CARELOG_RULES, load_carelogs),
    ):
        files = new_files(spark, folder, names, files_per_batch)
        run = lambda rows, load_id, load=load: load(rows, warehouse, load_id)
        process_in_batches(files, run, f"{checkpoint}/{kind}", rules, multi_line, refuse)
    retry_orphans(spark, warehouse)

"""The load job: raw rows to stored tables, repeatable at any time.

Rows already stored are recognised by their ids, so a load that was interrupted
is simply run again.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.operators import admit, dims, metrics
from visitlake.operators.clean import (
    CAREGIVER_RULES, CARELOG_RULES, Rule, clean_caregivers, clean_carelogs, readable, rejects,
)
from visitlake.operators.id_index import IdIndex
from visitlake.schemas import AGENCY, CAREGIVER, CARELOG, CORRUPT, FRANCHISOR, LOCATION, ORIGIN
from visitlake.session import shuffles_removed
from visitlake.sources import csv_files
from visitlake.sources.heads import NO_HEADER
from visitlake.sources.tables import append, read_table, scratch, staged, table_path

ORPHANS = "orphan_carelog"
REFUSED = "refused_file"
REFUSED_ROWS = "source_file string, reason string"
#: Rows of a file that the load appends, at most; ids of a batch touch few files anyway.
ROWS_PER_FILE = 2_000_000


def _set_aside(rows: DataFrame, warehouse: str, name: str, load_id: str) -> None:
    with shuffles_removed(rows.sparkSession):
        rows.write.mode("overwrite").parquet(f"{table_path(warehouse, name)}/load_id={load_id}")


def _report(counts: DataFrame, warehouse: str, kind: str, load_id: str) -> DataFrame:
    """Store the counts of a load once.

    They are stored before its rows, as a load that is repeated after a failure finds
    some rows stored already, and would count them as duplicates.
    """
    spark = counts.sparkSession
    path = f"{table_path(warehouse, 'load_metrics')}/kind={kind}/load_id={load_id}"
    try:
        return spark.read.schema(counts.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    with shuffles_removed(spark):
        counts.write.parquet(path)
    return spark.read.schema(counts.schema).parquet(path)


def _append(rows: DataFrame, warehouse: str, name: str, count: int | None = None) -> None:
    """Append in few files: as many partitions as the rows are worth.

    ``count`` says about how many rows there are where counting them would compute them twice.
    """
    count = rows.count() if count is None else count
    if count or not rows.isEmpty():
        append(rows.coalesce(max(1, -(-count // ROWS_PER_FILE) * 4)), warehouse, name)


def _known(spark: SparkSession, warehouse: str, table: str) -> IdIndex:
    """The ids of a stored table, with those of files that came since."""
    return IdIndex(spark, warehouse, table, f"{table}Id").sync()


def _timed(counts: DataFrame, load_id: str, began: float) -> DataFrame:
    return counts.withColumns({"load_id": F.lit(load_id), "elapsed_ms": F.lit((time.monotonic() - began) * 1000)})


def load_caregivers(raw: DataFrame, warehouse: str, load_id: str | None = None) -> DataFrame:
    """Store new franchisors, agencies, locations and caregivers; returns counts per file, with the load's id and time."""
    spark, load_id, began = raw.sparkSession, load_id or uuid.uuid4().hex, time.monotonic()
    with scratch(spark):
        raw = staged(raw, "raw-caregiver")
        for name, extract, table in [
            ("franchisor", dims.franchisors, FRANCHISOR),
            ("agency", dims.agencies, AGENCY),
            ("location", dims.locations, LOCATION),
        ]:
            _append(staged(extract(raw, read_table(spark, warehouse, name)).select(*table.fieldNames()), f"new-{name}"), warehouse, name)
        cleaned = clean_caregivers(raw)
        stored = _known(spark, warehouse, "caregiver")
        new = staged(admit.admit_caregivers(readable(cleaned, "caregiverId"), stored), "new-caregiver")
        _set_aside(rejects(cleaned, "caregiverId"), warehouse, "rejected_caregiver", load_id)
        counts = _report(metrics.per_file(cleaned, "caregiverId", stored), warehouse, "caregiver", load_id)
        _append(new.select(*CAREGIVER.fieldNames()), warehouse, "caregiver")
    return _timed(counts, load_id, began)


def load_carelogs(raw: DataFrame, warehouse: str, load_id: str | None = None) -> DataFrame:
    """Store new visits of known caregivers; returns counts per file, with the load's id and time."""
    spark, load_id, began = raw.sparkSession, load_id or uuid.uuid4().hex, time.monotonic()
    with scratch(spark):
        numbered = staged(admit.numbered(clean_carelogs(raw)), "clean-carelog")
        cleaned = numbered.drop(admit.NUMBER)
        rows, stored = readable(cleaned, "carelogId"), _known(spark, warehouse, "carelog")
        # written out, its size is known when the joins with the wide rows are planned
        unknown = staged(admit.unknown_caregivers(rows, _known(spark, warehouse, "caregiver")), "unknown-caregiver")
        _keep_orphans(admit.orphans(rows, unknown), warehouse)
        _set_aside(rejects(cleaned, "carelogId"), warehouse, "rejected_carelog", load_id)
        counts = _report(metrics.per_file(cleaned, "carelogId", stored, unknown), warehouse, "carelog", load_id)
        # ids, places and numbers decide which visits are new; the visits themselves go straight into the table
        narrow = readable(numbered.select("carelogId", "caregiverId", *ORIGIN, CORRUPT, admit.NUMBER), "carelogId")
        chosen = staged(admit.bits(admit.admit_carelogs(narrow, unknown, stored)), "chosen-carelog")
        # a repeated load has kept the counts of the first attempt
        new = admit.marked(numbered, chosen).select(*CARELOG.fieldNames())
        _append(new, warehouse, "carelog", counts.agg(F.sum("processed_rows")).first()[0] or 0)
    return _timed(counts, load_id, began)


def _keep_orphans(orphaned: DataFrame, warehouse: str) -> None:
    """Add waiting visits to the newest generation, those that wait already left out."""
    key = ["carelogId", "caregiverId"]
    waiting, folder = _waiting(orphaned.sparkSession, warehouse)
    new = staged(admit.not_stored(admit.first_rows(orphaned, key), waiting, key).select(*waiting.columns), "new-orphan")
    _append(new, f"{warehouse}/{ORPHANS}", folder)


def _waiting(spark: SparkSession, warehouse: str) -> tuple[DataFrame, str]:
    """Visits that still wait for their caregiver, and the folder of the newest generation of them.

    A generation holds all that waits. An earlier one stays until the owner removes it.
    """
    like = spark.createDataFrame([], CARELOG).select(
        "*", F.lit(None).cast("timestamp").alias("modified"), F.lit("").alias("source_file"),
        F.lit(0).cast("bigint").alias("block_start"), F.lit(0).cast("bigint").alias("row_id"),
    )
    marks = read_table(spark, warehouse, f"{ORPHANS}_generation", like=spark.createDataFrame([], "generation bigint"))
    folder = f"generation-{marks.agg(F.coalesce(F.max('generation'), F.lit(0))).first()[0]}"
    return read_table(spark, f"{warehouse}/{ORPHANS}", folder, like=like), folder


def retry_orphans(spark: SparkSession, warehouse: str) -> int:
    """Admit waiting visits whose caregiver has arrived since; returns how many.

    What still waits is written as a new generation, so that a visit is looked at no
    more once it is stored.
    """
    with scratch(spark):
        waiting, folder = _waiting(spark, warehouse)
        unknown = staged(admit.unknown_caregivers(waiting, _known(spark, warehouse, "caregiver")), "unknown-caregiver")
        new = staged(admit.admit_carelogs(waiting, unknown, _known(spark, warehouse, "carelog")), "retried-carelog")
        count = new.count()
        if count:
            _append(new.select(*CARELOG.fieldNames()), warehouse, "carelog")
            _report(
                new.groupBy("source_file").agg(F.count("*").alias("admitted_later")), warehouse, "orphan", uuid.uuid4().hex
            )
        still = admit.orphans(waiting, unknown)
        number = int(folder.rsplit("-", 1)[1]) + 1
        if count or not waiting.isEmpty() and still.isEmpty():
            with shuffles_removed(spark):
                still.write.parquet(table_path(f"{warehouse}/{ORPHANS}", f"generation-{number}"))
            append(spark.createDataFrame([(number,)], "generation bigint").coalesce(1), warehouse, f"{ORPHANS}_generation")
    return count


def missing_columns(file: csv_files.CsvFile, rules: list[Rule]) -> list[str]:
    return sorted({rule.field for rule in rules if rule.required} - set(file.header))


def refusal(file: csv_files.CsvFile, rules: list[Rule]) -> str | None:
    """Why a file cannot be loaded; None if it can."""
    if file.reason or not file.header:
        return file.reason or NO_HEADER
    missing = missing_columns(file, rules)
    return f"required columns not found: {', '.join(missing)}" if missing else None


def refuse(spark: SparkSession, refused: list[tuple[str, str]], warehouse: str) -> None:
    """Tell refused files, each with its reason, beside the stored tables."""
    if refused:
        append(spark.createDataFrame(refused, REFUSED_ROWS).coalesce(1), warehouse, REFUSED)


def run_load(spark: SparkSession, folder: str, warehouse: str, multi_line: bool = True) -> DataFrame:
    """Load every CSV file of a folder: caregivers first, then visits, then visits that waited.

    Files are told apart by name; others are left alone. A file that cannot be opened or
    decoded, or lacks a header or required columns, is told in ``refused_file``, and the
    others are loaded. Returns counts per file.
    """
    files = csv_files.discover(spark, folder)
    results = []
    for kind, rules, load in [
        ("caregiver", CAREGIVER_RULES, load_caregivers),
        ("carelog", CARELOG_RULES, load_carelogs),
    ]:
        mine = {f: refusal(f, rules) for f in files if csv_files.kind_of(f.name) == kind}
        refuse(spark, [(f.name, reason) for f, reason in mine.items() if reason], warehouse)
        good = [f for f, reason in mine.items() if not reason]
        if good:
            with scratch(spark):
                results.append(load(csv_files.read_files(spark, good, multi_line=multi_line), warehouse))
    if not results:
        raise FileNotFoundError(f"no caregiver or carelog CSV files to load in {folder}")
    retry_orphans(spark, warehouse)
    return reduce(DataFrame.unionByName, results)

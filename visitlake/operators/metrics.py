"""What became of every source row, per file and in total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlake.operators.admit import Stored, stored_among
from visitlake.operators.clean import UNREADABLE, reject_reason
from visitlake.schemas import ORIGIN

COUNTS = ["total_rows", "processed_rows", "failed_rows", "orphan_rows", UNREADABLE]


def per_file(cleaned: DataFrame, key: str, stored: Stored, unknown: DataFrame | None = None) -> DataFrame:
    """Rows read, admitted, rejected, orphaned per file, and times lost; the remainder are duplicates.

    The rows are read once. They are reduced to one per file, id and caregiver, of which
    the earliest readable one of a known caregiver is admitted if its id is not stored.
    What is compared per id are files, not rows.
    """
    bad = reject_reason(key).isNotNull()
    by = [key, "source_file"] + (["caregiverId"] if unknown is not None else [])
    reduced = cleaned.groupBy(*by).agg(
        F.count("*").alias("total_rows"),
        F.count_if(bad).alias("failed_rows"),
        F.sum(UNREADABLE).alias(UNREADABLE),
        F.min(F.when(~bad, F.struct(*ORIGIN))).alias("first"),
    )
    lost = F.lit(False)
    if unknown is not None:
        reduced = reduced.join(unknown.select("caregiverId", F.lit(True).alias("unknown")), "caregiverId", "left")
        lost = F.coalesce("unknown", F.lit(False))
    reduced = reduced.withColumns({
        "orphan_rows": F.when(lost, F.col("total_rows") - F.col("failed_rows")).otherwise(0),
        "first": F.when(~lost, F.col("first")),
    })
    known = stored_among(stored, reduced, [key]).withColumn("stored", F.lit(True))
    least = F.min("first").over(Window.partitionBy(key))
    placed = reduced.withColumn("least", least).join(known, key, "left")
    admitted = F.col("first").isNotNull() & (F.col("first") == F.col("least")) & F.col("stored").isNull()
    placed = placed.withColumn("processed_rows", F.coalesce(admitted, F.lit(False)).cast("int"))
    return with_duplicates(placed.groupBy("source_file").agg(*[F.sum(c).alias(c) for c in COUNTS]))


def with_duplicates(counts: DataFrame) -> DataFrame:
    rest = F.col("total_rows") - F.col("processed_rows") - F.col("failed_rows") - F.col("orphan_rows")
    return counts.withColumn("duplicate_rows", rest)


def totals(metrics: DataFrame, elapsed_ms: float | None = None) -> DataFrame:
    """One row over all files. The time is ``elapsed_ms``, or what the job measured and stored per file.

    Files loaded together carry the time of their load, which counts once.
    """
    names = [*COUNTS, "duplicate_rows"]
    measured = F.lit(float(elapsed_ms)) if elapsed_ms is not None else F.lit(0.0)
    if elapsed_ms is None and "elapsed_ms" in metrics.columns:
        measured = F.aggregate(F.collect_set(F.struct("load_id", "elapsed_ms")), F.lit(0.0), lambda total, x: total + x["elapsed_ms"])
    summed = metrics.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names], F.count("*").alias("files"), measured.alias("elapsed_ms"))
    processed, total, elapsed = F.col("processed_rows").cast("double"), F.col("total_rows"), F.col("elapsed_ms")
    return summed.withColumns(
        {
            "average_speed": F.when(elapsed > 0, processed / F.nullif(elapsed, F.lit(0.0)) * 1000).otherwise(F.lit(0.0)),
            "success_rate": F.when(total > 0, processed / F.nullif(total, F.lit(0)) * 100).otherwise(F.lit(0.0)),
        }
    )

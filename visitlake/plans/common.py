"""Pieces every report uses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.functions.exact import number

# Report lengths.
CAREGIVER_LIMIT = 50
VISIT_LIMIT = 100


def identity(status: str = "status") -> list[Column]:
    return [
        F.col("caregiverId"),
        F.concat("firstName", F.lit(" "), "lastName").alias("caregiver_name"),
        F.col("email"),
        F.col("phoneNumber"),
        F.col("status").alias(status),
    ]


def with_caregiver(stats: DataFrame, caregivers: DataFrame, status: str = "status") -> DataFrame:
    """Join on the caregiver id, which is unique; visits of unknown caregivers drop out."""
    return stats.join(caregivers.select(*identity(status)), "caregiverId")


def top(rows: DataFrame, descending: list[str], limit: int | None, last: str = "caregiverId") -> DataFrame:
    """Order by the given columns, unknown values first, ties by id; keep ``limit`` rows."""
    ordered = rows.orderBy(*[F.col(c).desc_nulls_first() for c in descending], F.col(last).asc())
    return ordered if limit is None else ordered.limit(limit)


def numbers(*names: str) -> list[Column]:
    """Output columns for measures kept in hundredths under ``<name>_h``."""
    return [number(F.col(f"{name}_h")).alias(name) for name in names]

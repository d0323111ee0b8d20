"""Constraint checks, since Parquet enforces none. Each returns one row per constraint."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.schemas import FOREIGN_KEYS, TABLES, UNIQUE_KEYS


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("bigint")


def unique_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Keys that occur more than once, and how many rows they have too many."""
    checks = []
    for table, key in UNIQUE_KEYS:
        repeated = tables[table].groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")
        checks.append(
            repeated.agg(
                F.lit(f"{table}({','.join(key)})").alias("constraint_name"),
                F.count("*").alias("repeated_keys"),
                _zero(F.sum(F.col("rows") - 1)).alias("surplus_rows"),
            )
        )
    return reduce(DataFrame.unionByName, checks)


def foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows that refer to a missing parent.

    Child keys are counted before the join, so a parent with very many children
    is one row there. Empty references (as the loader writes for a missing
    location) are counted apart from wrong ones.
    """
    checks = []
    for child, key, parent in FOREIGN_KEYS:
        used = tables[child].groupBy(*key).agg(F.count("*").alias("rows"))
        for c in key:
            used = used.where(F.col(c).isNotNull())
        broken = used.join(tables[parent].select(*key).distinct(), list(key), "left_anti")
        blank = reduce(Column.__or__, [F.col(c) == "" for c in key])
        checks.append(
            broken.agg(
                F.lit(f"{child}({','.join(key)})->{parent}").alias("constraint_name"),
                _zero(F.sum(F.when(~blank, F.col("rows")))).alias("violating_rows"),
                _zero(F.sum(F.when(blank, F.col("rows")))).alias("blank_rows"),
            )
        )
    return reduce(DataFrame.unionByName, checks)


def not_null(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows without a value, per column that must have one; one pass over each table."""
    checks = []
    for table, layout in TABLES.items():
        columns = [f.name for f in layout if not f.nullable]
        counted = tables[table].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        pairs = F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns])
        )
        checks.append(counted.select(F.lit(table).alias("table_name"), pairs.alias("pair")).select("table_name", "pair.*"))
    return reduce(DataFrame.unionByName, checks)

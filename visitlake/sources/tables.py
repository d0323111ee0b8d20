"""Stored tables: Parquet folders below one warehouse folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from visitlake.schemas import TABLES
from visitlake.session import fresh_path, prepare, shuffles_removed

#: Notes are most of what is stored, and take about half the room that the default codec leaves them.
COMPRESSION = "zstd"
#: Folders staged inside the innermost ``scratch``; None outside of one.
_staged_inside: ContextVar[list[str] | None] = ContextVar("_staged_inside", default=None)


def table_path(warehouse: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/{name}"


def read_table(spark: SparkSession, warehouse: str, name: str, like: DataFrame | None = None) -> DataFrame:
    """A stored table, empty if nothing was stored yet."""
    schema = like.schema if like is not None else TABLES[name]
    try:
        return prepare(spark).read.schema(schema).parquet(table_path(warehouse, name))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append(rows: DataFrame, warehouse: str, name: str) -> None:
    with shuffles_removed(rows.sparkSession):
        rows.write.mode("append").option("compression", COMPRESSION).parquet(table_path(warehouse, name))


def staged(rows: DataFrame, name: str) -> DataFrame:
    """Rows written once to the shared folder and read back.

    Several steps use them; without this each would parse the source again, and
    a lost executor could number the rows anew.
    """
    spark = rows.sparkSession
    path = fresh_path(spark, name)
    inside = _staged_inside.get()
    if inside is not None:
        inside.append(path)
    with shuffles_removed(spark):
        rows.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Rows staged inside are removed at the end, and no frame over them may be used behind it."""
    mine: list[str] = []
    token = _staged_inside.set(mine)
    try:
        yield
    finally:
        _staged_inside.reset(token)
        for path in mine:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)

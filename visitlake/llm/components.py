"""Connected components of pairs, as a series of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.session import fresh_path

#: Rounds beyond which something is wrong: each halves the longest way, at least.
MOST_ROUNDS = 80


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read back: lineage ends there."""
    spark = rows.sparkSession
    path = fresh_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("node", "root").cast("decimal(38,0)")), F.lit(0))).first()
    return int(row[0]), int(row[1])


def components(pairs: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest id) of all ids in pairs, but for the roots themselves.

    ``pairs`` has two columns of one type, in any order and with repeats; equal or
    null ends are left out. Large and small stars alternate until nothing changes: all
    of a node's neighbours go to their smallest one, first the larger neighbours and
    then the smaller ones. The smallest neighbour is an aggregate that is reduced
    before the shuffle; the join that follows has one row per node on that side, and
    Spark splits its other side where a node has very many neighbours.
    """
    a, b = pairs.columns
    edges = pairs.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).distinct()
    edges = stored(edges, "components")
    state = _state(edges)
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("least")).select("node", F.least("node", "least").alias("least"))
        large = (
            both.join(least, "node")
            .where(F.col("root") > F.col("node"))
            .select(F.col("root").alias("node"), F.col("least").alias("root"))
            .distinct()
        )
        large = stored(large, "components")
        lowest = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(lowest, "node").where(F.col("root") != F.col("least")).select(F.col("root").alias("node"), F.col("least").alias("root"))
        edges = stored(small.unionByName(lowest.select("node", F.col("least").alias("root"))).distinct(), "components")
        before, state = state, _state(edges)
        if state == before:
            return edges
    raise RuntimeError("components did not settle")

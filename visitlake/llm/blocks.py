"""Comparing the members of buckets with each other, a bounded number in one task.

A bucket of more members than a block is dealt into blocks, and every pair of blocks
is a piece of work of its own, so that no task holds a whole large bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACE = ["bucket", "low", "high"]


def deal(rows: DataFrame, member: str, block: int) -> DataFrame:
    """``rows`` (bucket, size and others), once for each pair of blocks that a row is part of.

    Adds ``low`` and ``high``, the pair, and ``side``: 1 for rows of the high block of
    two. Most buckets are one block, whose rows stay single.
    """
    blocks = F.ceil(F.col("size") / block).cast("int")
    met = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(
            F.least(k, F.col("block")).alias("low"), F.greatest(k, F.col("block")).alias("high"), (k < F.col("block")).cast("int").alias("side")
        ),
    )
    dealt = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("met", F.explode(met))
    return dealt.select(*[c for c in rows.columns if c != "size"], "met.*")


def deal_within(rows: DataFrame, member: str, block: int) -> DataFrame:
    """``rows`` (bucket, size and others), each in one block: members of one block meet, no others.

    A member's block differs from bucket to bucket.
    """
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64(member, "bucket"), blocks).cast("int")
    dealt = rows.withColumn("low", own).withColumn("high", own).withColumn("side", F.lit(0))
    return dealt.select(*[c for c in rows.columns if c != "size"], "low", "high", "side")


def gathered(dealt: DataFrame, columns: list[str], work: Callable[[Iterator[list[tuple]]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``work`` to the stream of a task's block pairs, each a list of rows.

    A row is a tuple of bucket, low, high, side and ``columns``.
    """

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:3] != row[:3]:
                    yield held
                    held = []
                held.append(row)
        if held:
            yield held

    rows = dealt.select(*PLACE, "side", *columns).repartition(*PLACE).sortWithinPartitions(*PLACE)
    return rows.mapInArrow(lambda batches: work(groups(batches)), schema)

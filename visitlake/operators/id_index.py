"""Index of stored ids: which ids of a load are stored, without reading all that are.

Ids are dealt by hash into buckets, each a folder of Parquet files. Beside them lies a
blocked Bloom filter: an id belongs to one block of its bucket and sets some bits there,
and a row of the filter is a block of eight whole numbers. A load looks its ids up in
the filter, and reads only the buckets of which a block has all the bits of one of them.

The index names the data files whose ids it holds. ``sync`` adds the ids of files not
named yet, so that a load that was interrupted between table and index, or rows that
were appended by something else, are found at the next look. An id that was added
twice is harmless.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.session import shuffles_removed
from visitlake.sources.tables import append, read_table, table_path

#: Ids a bucket is meant to hold, and how many times that before the ids are dealt anew.
IDS_PER_BUCKET = 1_000_000
OVERFULL = 4
#: Bits of the filter per id, and words of a block, in each of which an id sets one bit:
#: about one in a thousand unknown ids passes.
BITS_PER_ID = 16
WORDS = 8
BLOCK_BITS = 64 * WORDS
FILTER = [f"word{k}" for k in range(WORDS)]
FILTER_ROWS = "bucket int, block int, " + ", ".join(f"{w} bigint" for w in FILTER)
#: A row per data file taken in, with the layout of the index at that time.
COVERED = "generation int, buckets int, blocks int, ids bigint, file string"


def _hash(key: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), key)


def _bits(key: Column) -> list[Column]:
    """The bit that an id sets in each of the words of its block: six bits of one hash name it."""
    spot = _hash(key, 3)
    one = F.lit(1).cast("bigint")
    return [
        F.call_function("shiftleft", one, F.shiftrightunsigned(spot, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(WORDS)
    ]


class IdIndex:
    """Ids of one column of a stored table. ``spark`` and the warehouse folder say where."""

    def __init__(self, spark: SparkSession, warehouse: str, table: str, key: str, ids_per_bucket: int = IDS_PER_BUCKET):
        self.spark, self.key, self.table = spark, key, table
        self.warehouse, self.home = warehouse, f"{table_path(warehouse, 'id_index')}/{table}"
        self.ids_per_bucket = ids_per_bucket
        self._load()

    def _read(self, name: str, layout: str) -> DataFrame:
        return read_table(self.spark, self.home, name, like=self.spark.createDataFrame([], layout))

    def _load(self) -> None:
        """What the index covers: one small job, with a row per data file of the table."""
        rows = list(self._read("covered", COVERED).toLocalIterator())
        self.generation, self.buckets, self.blocks = max([tuple(r)[:3] for r in rows], default=(-1, 0, 0))
        mine = [r for r in rows if r["generation"] == self.generation]
        self.covered = {r["file"] for r in mine}
        self.size = sum(r["ids"] for r in mine)
        self.folder = f"{self.home}/generation-{self.generation}"

    def _cover(self, files: list[str], ids: int) -> None:
        """Make what was written count, in one row per file; the first tells how many ids."""
        told = [(self.generation, self.buckets, self.blocks, 0 if k else ids, f) for k, f in enumerate(files)]
        append(self.spark.createDataFrame(told, COVERED).coalesce(1), self.home, "covered")
        self.covered |= set(files)
        self.size += ids

    def place(self, ids: DataFrame) -> DataFrame:
        """``ids`` with the bucket and block of each."""
        spot = _hash(F.col(self.key), 1)
        return ids.withColumns({
            "bucket": F.pmod(spot, F.lit(self.buckets)).cast("int"),
            "block": F.pmod(_hash(F.col(self.key), 2), F.lit(self.blocks)).cast("int"),
        })

    def _write(self, ids: DataFrame) -> None:
        placed = self.place(ids)
        # a bucket of a load is one file, unless it is so large that it is spread
        with shuffles_removed(self.spark):
            placed.select(self.key, "bucket").repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.folder}/ids")
        words = placed.select("bucket", "block", *[b.alias(w) for w, b in zip(FILTER, _bits(F.col(self.key)), strict=True)])
        rows = words.groupBy("bucket", "block").agg(*[F.bit_or(w).alias(w) for w in FILTER])
        with shuffles_removed(self.spark):
            rows.sortWithinPartitions("bucket", "block").write.mode("append").parquet(f"{self.folder}/filter")

    def rebuild(self, ids: DataFrame, count: int) -> None:
        """Deal all ids anew, into as many buckets as they fill."""
        self.generation += 1
        self.covered, self.size = set(), 0
        self.buckets = max(1, -(-2 * count // self.ids_per_bucket))
        self.blocks = max(1, self.ids_per_bucket * BITS_PER_ID // BLOCK_BITS)
        self.folder = f"{self.home}/generation-{self.generation}"
        self._write(ids.where(F.col(self.key).isNotNull()).distinct())

    def sync(self) -> IdIndex:
        """Take in the ids of the table's files that the index does not know; returns the index."""
        stored = read_table(self.spark, self.warehouse, self.table)
        files = {f.rsplit("/", 1)[-1]: f for f in stored.inputFiles()}
        new = sorted(files.keys() - self.covered)
        if not new:
            return self
        ids = self.spark.read.schema(stored.schema).parquet(*[files[f] for f in new]).select(self.key)
        added = ids.count()  # from the files' own counts
        if self.generation < 0 or self.size + added > OVERFULL * self.ids_per_bucket * self.buckets:
            added += self.size
            self.rebuild(stored.select(self.key), added)
            new = sorted(files)
        elif added:
            self._write(ids.where(F.col(self.key).isNotNull()))
        self._cover(new, added)
        return self

    def possible(self, ids: DataFrame) -> DataFrame:
        """Ids that the filter lets pass, with their buckets: all that are stored, and few others."""
        bits = [b.alias(f"own_{w}") for w, b in zip(FILTER, _bits(F.col(self.key)), strict=True)]
        wanted = self.place(ids.select(self.key).where(F.col(self.key).isNotNull()).distinct()).select("*", *bits)
        rows = self.spark.read.schema(FILTER_ROWS).parquet(f"{self.folder}/filter")
        passes = reduce(Column.__and__, [F.col(w).bitwiseAND(F.col(f"own_{w}")) == F.col(f"own_{w}") for w in FILTER])
        return wanted.join(rows, ["bucket", "block"]).where(passes).select(self.key, "bucket").distinct()

    def bucket_rows(self, buckets: list[int]) -> DataFrame:
        """Stored ids of some buckets; no file of another one is opened."""
        rows = self.spark.read.schema(f"`{self.key}` string, bucket int").parquet(f"{self.folder}/ids")
        return rows.where(F.col("bucket").isin(buckets))

    def among(self, ids: DataFrame) -> DataFrame:
        """Those of ``ids`` that are stored, once each. The driver sees the numbers of the buckets concerned."""
        nothing = ids.select(self.key).where("1 = 0")
        if self.generation < 0:
            return nothing
        maybe = self.possible(ids)
        buckets = sorted(r["bucket"] for r in maybe.select("bucket").distinct().toLocalIterator())
        if not buckets:
            return nothing
        return self.bucket_rows(buckets).join(maybe, ["bucket", self.key], "left_semi").select(self.key).distinct()

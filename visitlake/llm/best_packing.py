"""Packing whole documents into as few windows as possible (operator 12).

Documents are coded once and written, cut only where they are longer than a window. The
histogram of the lengths of their pieces, which has at most as many rows as a window has
tokens, is all that the driver sees; from it come mixes of lengths that fill windows
(see ``mixes``). The pieces of one length then take the places for that length in any
order: a piece's number among those of its length, counted by task and length, names its
window and its offset.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlake.llm.components import stored
from visitlake.llm.mixes import Mix, mixes
from visitlake.llm.word_ids import coder

WINDOW = 4096
#: End-of-document id.
END_ID = 1
TEXTS_PER_PART = 500


def coded_pieces(docs: DataFrame, path: str, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of coded documents with ``task`` and ``place``: their number among the task's pieces of one length."""
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    names = [key, "piece", "start", "length", "ids_crc32", "task", "place", "piece_ids"]
    schema = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, place bigint, piece_ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = coder(path), np.array([END_ID], "<u4").tobytes()
        task = TaskContext.get().partitionId()
        met = np.zeros(window + 1, np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, TEXTS_PER_PART):
                part = batch.slice(begin, TEXTS_PER_PART)
                owners, told = [], []
                for row, ids in enumerate(own.code(part.column(1).to_pylist())):
                    whole = ids + end
                    for piece, start in enumerate(range(0, len(whole), 4 * window)):
                        mine = whole[start : start + 4 * window]
                        size = len(mine) // 4
                        owners.append(row)
                        told.append((piece, start // 4, size, zlib.crc32(mine), task, int(met[size]), mine))
                        met[size] += 1
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*told, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owners)), *columns], names)

    return rows.mapInArrow(run, schema)


class Places:
    """Where the pieces of a length go, by their number among them."""

    def __init__(self, found: list[Mix], window: int):
        self.window = window
        rows = []
        first: dict[int, int] = {}
        sequence = 0
        for mix in found:
            offset = 0
            for length, times in mix.lengths:
                rows.append((length, first.get(length, 0), times, sequence, offset))
                first[length] = first.get(length, 0) + times * mix.copies
                offset += length * times
            sequence += mix.copies
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.first, self.times, self.sequence, self.offset = table.T.copy()
        self.begins = np.searchsorted(self.length, np.arange(window + 2))

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces."""
        # numbers of one length count from 0 and are looked up among the rows of that length
        span = int(max(number.max(initial=0), self.first.max(initial=0))) + 1
        at = np.searchsorted(self.length * span + self.first, length * span + number, "right") - 1
        copy, turn = np.divmod(number - self.first[at], self.times[at])
        return self.sequence[at] + copy, self.offset[at] + turn * length


def pack(docs: DataFrame, path: str, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of a document: where it lies, and its ids.

    Columns: ``key``, ``piece`` (from 0), ``start`` (ids of the document before it),
    ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` and ``piece_ids`` (32 bits
    each, little-endian). Only documents of more than ``window`` ids are cut, into full
    windows and a last piece. A null or empty text is its end id alone. Repeated rows
    and null keys are packed each. Other columns of ``docs`` are not read. An empty table
    gives no rows. The vocabulary file must lie at ``path`` on every executor.

    What travels between tasks are pieces without ids, unless ids are asked for. The
    table of places has a row per mix and length of it; mixes are bounded by what one
    solution can use and by windows of what is left over, of which there are at most as
    many kinds as lengths, whatever the number of documents.
    """
    pieces = stored(coded_pieces(docs, path, window, key, text), "coded-pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("pieces"))
    histogram = {r["length"]: r["pieces"] for r in by_task.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}
    places = Places(mixes(histogram, window), window)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("length", "task", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("before"))
    numbered = pieces.join(offsets, ["length", "task"]).withColumn("number", F.col("before") + F.col("place"))

    # places of one length are ranges of numbers, so that a lookup suffices
    @F.pandas_udf("sequence_id bigint, offset bigint")
    def placed_at(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = places.find(length.to_numpy(), number.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    found = numbered.withColumn("at", placed_at("length", "number"))
    return found.select(key, "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset", "piece_ids")


def placed(docs: DataFrame, path: str) -> DataFrame:
    """Pieces without their ids."""
    return pack(docs, path).drop("piece_ids")

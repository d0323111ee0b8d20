"""First records of many files, read from their beginnings only.

A file is opened in a task and read in small steps until its first record ends; a line
break between quotes ends none. Whatever goes wrong with a file, it is told as that
file's reason, and the others go on.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a step, and of a first record at most.
STEP = 16_384
LONGEST_HEAD = 4_000_000
RESULT = "path string, length bigint, modificationTime timestamp, head string, bytes_read bigint, reason string"
NO_HEADER = "no header"
UNDECODABLE = "not UTF-8 text"
ENDLESS = f"no end of the first record in {LONGEST_HEAD} bytes"

# a quoted value begins behind a comma or a line break only; the dangling end is one still open
_QUOTED = re.compile(rb'(?:(?<=^)|(?<=[,\n]))"(?:[^"]|"")*(?:"|\Z)')


class Unreachable(Exception):
    """No library here opens such a path, although Spark may."""


def open_file(path: str) -> BinaryIO:
    """A file by its path or address."""
    try:
        if "://" in path and not path.startswith("file:"):
            store, place = fs.FileSystem.from_uri(quote(path, safe=":/@"))
        else:
            store, place = fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError) as error:
        raise Unreachable(str(error)) from error
    return store.open_input_stream(place, compression=None, buffer_size=None)


def record_end(data: bytes) -> int:
    """Where the first record ends that is not blank, its line break included; -1 if it does not."""
    blank = re.match(rb"[\r\n]*", data).end()
    bare = _QUOTED.sub(lambda m: b"x" * len(m.group()), data[blank:])
    end = bare.find(b"\n")
    return blank + end + 1 if end >= 0 else -1


def read_head(file: BinaryIO) -> tuple[bytes, int]:
    """The first record, and how many bytes were read for it."""
    data, step = b"", STEP
    while len(data) < LONGEST_HEAD:
        more = file.read(step)
        data += more
        end = record_end(data)
        if end >= 0:
            return data[:end], len(data)
        if not more:
            return data, len(data)
        step = max(STEP, len(data))  # look again at twice as much, not at all for every step
    raise ValueError(ENDLESS)


def columns_of(head: str | None) -> tuple[str, ...]:
    """Column names of a first record."""
    if not head:
        return ()
    return tuple(next(csv.reader([head.strip("\r\n").lstrip("﻿")]), []))


def told(path: str, opener: Callable[[str], BinaryIO] = open_file) -> tuple[str | None, int, str | None]:
    """First record, bytes read and reason of refusal of one file."""
    try:
        with opener(path) as file:
            data, size = read_head(file)
        if b"\0" in data:
            return None, size, UNDECODABLE
        head = data.decode("utf-8")
    except Unreachable:
        raise
    except UnicodeDecodeError:
        return None, size, UNDECODABLE
    except (OSError, ValueError) as error:
        return None, 0, f"{type(error).__name__}: {error}"
    return head, size, None if any(columns_of(head)) else NO_HEADER


def heads(listing: DataFrame) -> DataFrame:
    """First record, bytes read and reason of refusal of listed files (path, length, modificationTime).

    A path that nothing here can open has neither head nor reason; the caller then reads
    it in another way.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                try:
                    rows.append(told(path))
                except Unreachable:
                    rows.append((None, 0, None))
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            made = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], ["path", "length", "modificationTime", "head", "bytes_read", "reason"])

    spread = listing.repartition(F.xxhash64("path"))
    return spread.select("path", "length", "modificationTime").mapInArrow(run, RESULT)

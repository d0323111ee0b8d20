"""WARC archives as a Spark data source, reading and writing (operator 2).

``spark.read.format("warc")`` plans partitions of whole files, small ones together.
Predicates on record type and header columns are pushed down. A task parses a
record's headers first; if they fail, or if no payload is wanted, the payload is
passed over without decoding it. In compressed archives every record is a gzip
member of its own, whose extra field holds the member's length (subfield "sl", as in
the format's annex on compression), so that it is passed over by seeking. Members
without that field are decoded to find their end.

``df.write.format("warc")`` writes one archive after the other per task, each under a
name of its own attempt; the driver moves those of successful tasks into place.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull,
    StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.types import BinaryType, LongType, MapType, StringType, StructType

from visitlake.session import fresh_path

VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads shorter than this are written out even if another record has the same.
LEAST_REVISITED = 100
#: An archive is closed when it has this many bytes, and a new one begun.
ARCHIVE_BYTES = 256 << 20
#: Files are read together until they have this many bytes; a larger one is read alone.
PARTITION_BYTES = 64 << 20
HEAD_BYTES = 4096

SCHEMA = StructType()
for _name, _type in (
    ("record_type", StringType()), ("record_id", StringType()), ("target_uri", StringType()), ("refers_to", StringType()),
    ("payload_digest", StringType()), ("content_length", LongType()), ("headers", MapType(StringType(), StringType())),
    ("payload", BinaryType()), ("file", StringType()), ("file_offset", LongType()),
):
    SCHEMA = SCHEMA.add(_name, _type)
#: Columns that are headers, by the header's name in lower case.
HEADERS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest",
}


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it, for any store that Arrow knows."""
    if not urlparse(path).scheme:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("file:///", "file:/").replace("file:/", "file:///"))


@dataclass
class FilesPartition(InputPartition):
    files: list[str]


class Archives(DataSource):
    """Options: ``path`` (folder or file), ``payload`` (false: leave payloads out), ``compressed`` (writing, default true)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> StructType:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArchiveReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return ArchiveWriter(self.options, schema, overwrite)


def _accepts(headers: dict[str, str], tests: list[tuple[str, str, Any]]) -> bool:
    """Whether the headers pass the pushed tests (header, kind, value); SQL's null rules."""
    for header, kind, value in tests:
        told = headers.get(header)
        if kind == "null":
            good = (told is None) == value
        elif kind == "same":
            good = told == value
        elif told is None:
            good = False
        elif kind == "in":
            good = told in value
        else:
            good = getattr(told, kind)(value)
        if not good:
            return False
    return True


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path = options["path"]
        self.names = schema.names
        self.payload = "payload" in self.names and options.get("payload", "true").lower() != "false"
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, Any]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        kinds = {StringStartsWith: "startswith", StringEndsWith: "endswith", StringContains: "__contains__"}
        for test in filters:
            header = HEADERS.get(test.attribute[0]) if len(getattr(test, "attribute", ())) == 1 else None
            if header is None:
                yield test
            elif isinstance(test, EqualTo):
                self.tests.append((header, "in", (test.value,)))
            elif isinstance(test, EqualNullSafe):
                self.tests.append((header, "same", test.value))
            elif isinstance(test, In):
                self.tests.append((header, "in", test.value))
            elif isinstance(test, IsNull | IsNotNull):
                self.tests.append((header, "null", isinstance(test, IsNull)))
            elif type(test) in kinds:
                self.tests.append((header, kinds[type(test)], test.value))
            else:
                yield test

    def partitions(self) -> list[FilesPartition]:
        store, path = open_store(self.path)
        told = store.get_file_info(path)
        if told.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [told] if told.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path, recursive=True))
        files = [f for f in files if f.type == fs.FileType.File and _is_archive(f.path[len(path) :] if f is not told else f.base_name)]
        files.sort(key=lambda f: (-f.size, f.path))
        planned: list[tuple[int, list[str]]] = []
        for f in files:
            if planned and planned[-1][0] + f.size <= self.partition_bytes:
                planned[-1] = (planned[-1][0] + f.size, [*planned[-1][1], f.path])
            else:
                planned.append((f.size, [f.path]))
        return [FilesPartition(paths) for _, paths in planned] or [FilesPartition([])]

    def read(self, partition: FilesPartition) -> Iterator[tuple]:
        store, _ = open_store(self.path)
        for path in partition.files:
            with store.open_input_file(path) as file:
                for offset, headers, payload in records(file, self.tests, self.payload):
                    told = {n: headers.get(h) for n, h in HEADERS.items()}
                    told |= {"content_length": int(headers["content-length"]), "headers": headers, "payload": payload, "file": path, "file_offset": offset}
                    yield tuple(told[n] for n in self.names)


def _is_archive(path: str) -> bool:
    hidden = any(part.startswith(("_", ".")) for part in path.split("/"))
    return not hidden and path.endswith((".warc", ".warc.gz"))


def records(file: pa.NativeFile, tests: list[tuple[str, str, Any]], wanted: bool) -> Iterator[tuple[int, dict[str, str], bytes | None]]:
    """Offset, headers and payload of the records that pass ``tests``."""
    size = file.size()
    offset = 0
    while offset < size:
        start = file.read_at(min(HEAD_BYTES, size - offset), offset)
        if start[:2] == b"\x1f\x8b":
            headers, payload, length = _member(file, offset, start, tests, wanted)
        else:
            headers, payload, length = _plain(file, offset, start, tests, wanted, size)
        if headers is not None:
            yield offset, headers, payload
        offset += length


def parse_headers(block: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a folded line continues the one before."""
    lines = block.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields: dict[str, str] = {}
    last = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            fields[last] = value.strip()
    return fields


def _plain(file, offset: int, start: bytes, tests: list, wanted: bool, size: int) -> tuple[dict | None, bytes | None, int]:
    head = start
    while (end := head.find(b"\r\n\r\n")) < 0:
        if offset + len(head) >= size:
            raise ValueError(f"record at {offset} has no end of headers")
        head += file.read_at(min(HEAD_BYTES, size - offset - len(head)), offset + len(head))
    headers = parse_headers(head[:end])
    length = int(headers["content-length"])
    total = end + 4 + length + 4
    if not _accepts(headers, tests):
        return None, None, total
    return headers, file.read_at(length, offset + end + 4) if wanted else None, total


def _member_length(start: bytes) -> int | None:
    """Length of a gzip member, if its extra field tells it."""
    if not start[3] & 4:
        return None
    total, at = struct.unpack_from("<H", start, 10)[0], 12
    while at < 12 + total:
        name, size = start[at : at + 2], struct.unpack_from("<H", start, at + 2)[0]
        if name == b"sl" and size == 8:
            return struct.unpack_from("<I", start, at + 4)[0]
        at += 4 + size
    return None


def _member(file, offset: int, start: bytes, tests: list, wanted: bool) -> tuple[dict | None, bytes | None, int]:
    told = _member_length(start)
    unpack = zlib.decompressobj(wbits=31)
    read, head, end = len(start), b"", -1
    piece = start if told is None else start[:told]
    while True:
        # headers first: no more is decoded than it takes to see their end
        while piece and end < 0:
            head += unpack.decompress(piece, HEAD_BYTES)
            end, piece = head.find(b"\r\n\r\n"), unpack.unconsumed_tail
        if end >= 0 or unpack.eof:
            break
        piece = file.read_at(HEAD_BYTES, offset + read)
        if not piece:
            break
        read += len(piece)
    if end < 0:
        raise ValueError(f"record at {offset} has no end of headers")
    headers = parse_headers(head[:end])
    good = _accepts(headers, tests)
    if told is not None and not (good and wanted):
        return (headers if good else None), None, told
    rest = [head[end + 4 :]]
    while not unpack.eof:
        if not piece:
            piece = file.read_at(1 << 16 if told is None else max(1, told - read), offset + read)
            read += len(piece)
            if not piece:
                raise ValueError(f"record at {offset} is cut off")
        data = unpack.decompress(piece, 1 << 20)
        if good and wanted:
            rest.append(data)
        piece = unpack.unconsumed_tail
    # bytes behind the member belong to the next one
    length = read - len(unpack.unused_data)
    if told is not None:
        length = told
    payload = b"".join(rest)[: int(headers["content-length"])] if good and wanted else None
    return (headers if good else None), payload, length


def record_bytes(headers: list[tuple[str, str]], payload: bytes, compressed: bool) -> bytes:
    """One record; a compressed one is a gzip member that tells its own length."""
    lines = [VERSION, *(f"{name}: {_one_line(value)}".encode() for name, value in headers), b"Content-Length: %d" % len(payload)]
    data = b"\r\n".join(lines) + b"\r\n\r\n" + payload + b"\r\n\r\n"
    if not compressed:
        return data
    pack = zlib.compressobj(4, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _one_line(value: str) -> str:
    return " ".join(str(value).split())


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class ArchiveWriter(DataSourceWriter):
    """Rows of the reader's columns: record_type, record_id, target_uri, refers_to, payload_digest, payload and headers count."""

    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool):
        self.path, self.names, self.overwrite = options["path"].rstrip("/"), schema.names, overwrite
        self.compressed = options.get("compressed", "true").lower() != "false"
        self.most = int(options.get("archivebytes", ARCHIVE_BYTES))
        self.job = uuid.uuid4().hex
        if overwrite:
            store, path = open_store(self.path)
            if store.get_file_info(path).type == fs.FileType.Directory:
                store.delete_dir_contents(path)

    def write(self, rows: Iterator) -> Written:
        store, top = open_store(self.path)
        folder = f"{top}/_{self.job}"
        store.create_dir(folder, recursive=True)
        files: list[tuple[str, str]] = []
        out, size = None, 0
        try:
            for row in rows:
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc" + ".gz" * self.compressed
                    files.append((f"{folder}/{name}", f"{top}/{name}"))
                    out, size = store.open_output_stream(files[-1][0], compression=None), 0
                told = dict(zip(self.names, row, strict=True))
                data = record_bytes(self._headers(told), bytes(told.get("payload") or b""), self.compressed)
                out.write(data)
                size += len(data)
                if size >= self.most:
                    out.close()
                    out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    @staticmethod
    def _headers(told: dict[str, Any]) -> list[tuple[str, str]]:
        named = {
            "WARC-Type": told.get("record_type"), "WARC-Record-ID": told.get("record_id"), "WARC-Target-URI": told.get("target_uri"),
            "WARC-Refers-To": told.get("refers_to"), "WARC-Payload-Digest": told.get("payload_digest"),
        }
        fixed = [(k, v) for k, v in named.items() if v is not None]
        known = {k.lower() for k, _ in fixed} | {"content-length"}
        return fixed + [(k, v) for k, v in (told.get("headers") or {}).items() if k.lower() not in known and v is not None]

    def commit(self, messages: list[Written | None]) -> None:
        store, top = open_store(self.path)
        store.create_dir(top, recursive=True)
        for message in messages:
            for temporary, final in message.files if message else []:
                store.move(temporary, final)
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        store, top = open_store(self.path)
        if store.get_file_info(f"{top}/_{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{top}/_{self.job}")


def register(spark) -> None:
    """Make the format known to a session, with predicate pushdown."""
    spark.dataSource.register(Archives)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def _record_id(column: F.Column) -> F.Column:
    return F.concat(F.lit("<urn:page:"), column.cast("string"), F.lit(">"))


def page_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A record per page; of equal payloads of LEAST_REVISITED bytes or more, all but that of the smallest key revisit it.

    Only digests and keys are grouped, reduced before the shuffle. A digest that
    several pages share holds perhaps a third of all pages: those few that hold at
    least a thousandth each are joined by broadcast (a thousand rows at most), the
    others by a shuffle, in which no key is large.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    sized = rows.where(F.octet_length("payload") >= LEAST_REVISITED)
    shared = sized.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    total = rows.count()
    hot = shared.where(F.col("copies") * 1000 >= total).select("digest", F.col("first").alias("hot_first"))
    cold = shared.where(F.col("copies") * 1000 < total).select("digest", "first")
    marked = rows.join(F.broadcast(hot), "digest", "left")
    # pages of the hot digests get keys of their own, so that they spread over all tasks
    cold_key = F.when(F.col("hot_first").isNull(), F.col("digest")).otherwise(F.concat(F.lit("hot-"), F.col("page_id").cast("string")))
    found = marked.withColumn("cold_key", cold_key).join(cold.withColumnRenamed("digest", "cold_key"), "cold_key", "left")
    first = F.when(F.octet_length("payload") >= LEAST_REVISITED, F.coalesce("hot_first", "first"))
    found = found.withColumn("first", first).withColumn("revisit", F.coalesce(F.col("page_id") != F.col("first"), F.lit(False)))
    return found.select(
        F.when(F.col("revisit"), "revisit").otherwise("response").alias("record_type"),
        _record_id(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(F.col("revisit"), _record_id(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        F.create_map(
            F.lit("X-Page-Id"), F.col("page_id").cast("string"), F.lit("X-Payload-Bytes"), F.octet_length("payload").cast("string"),
            F.lit("WARC-Profile"), F.when(F.col("revisit"), F.lit(REVISIT_PROFILE)),
        ).alias("headers"),
        F.when(~F.col("revisit"), F.col("payload")).alias("payload"),
    )


def archived(pages: DataFrame) -> DataFrame:
    """Write a record per page, read the archives back, and tell what they hold.

    Null html is an empty payload. Size and digest of a response are those of the
    payload that was read; a revisit has none of its own and tells those of the
    response it refers to, without its payload being looked for. Repeated page ids
    each give their record; the same id is no revisit of itself. A null id stays null.
    """
    spark = pages.sparkSession
    register(spark)
    folder = fresh_path(spark, "warc")
    page_records(pages).write.format("warc").mode("append").save(folder)
    read = spark.read.format("warc").load(folder)
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).cast("long")
    page = F.col("headers")["x-page-id"].cast("long").alias("page_id")
    responses = read.where("record_type = 'response'").select(
        page, F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"),
    )
    revisits = spark.read.format("warc").option("payload", "false").load(folder).where("record_type = 'revisit'").select(
        page, F.col("headers")["x-payload-bytes"].cast("long").alias("payload_bytes"), F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"),
    )
    return responses.unionByName(revisits)

"""Packing token ids into windows of equal length, by sums of squares (operator 9).

Each task packs the documents it reads, in one pass and without a shuffle. A document
goes to the fill level that makes the sum of the squared numbers of partly filled
windows per level smallest. A document longer than a window fills whole windows
first, and only its rest is placed. What is still partly filled in the end is cut
into full windows, and the last rest into windows whose lengths are powers of two,
which need no padding.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.token_counts import byte_characters

#: Padding and end-of-document id of the vocabulary used.
END_ID = 1
WINDOW = 2048
#: Partly filled windows a task holds before it cuts documents to fill them.
OPEN_WINDOWS = 4096
ROWS_PER_BATCH = 2000

Piece = tuple[object, int, int, bytes]  # document, start, tokens of the document, ids


class LevelPacker:
    """Windows by fill level; ``closed`` collects the full ones."""

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN_WINDOWS):
        self.window, self.limit = window, open_windows
        self.counts = np.zeros(window + 1, np.int64)
        self.levels: dict[int, list[list[Piece]]] = {}
        self.open = 0
        self.closed: list[list[Piece]] = []

    def best_level(self, size: int) -> int:
        """Fill level to put ``size`` ids on; 0 opens a window. Ties go to the fullest."""
        top = self.window - size
        here, there = self.counts[1 : top + 1], self.counts[size + 1 : size + top + 1]
        change = np.where(here > 0, 2 * (there - here) + 2, np.iinfo(np.int64).max)
        if top and here[-1] > 0:
            change[-1] -= 1  # a full window is no longer counted
        change = np.r_[2 * self.counts[size] + 1, change]
        return int(len(change) - 1 - np.argmin(change[::-1]))

    def place(self, piece: Piece) -> None:
        size = len(piece[3]) // 4
        if size == self.window:
            self.closed.append([piece])
            return
        level = self.best_level(size)
        pieces = self._take(level) if level else []
        self._put([*pieces, piece], level + size)
        if self.open > self.limit:
            self.fill_up()

    def add(self, document: object, ids: bytes) -> None:
        total, step = len(ids) // 4, self.window
        for start in range(0, total, step):
            self.place((document, start, total, ids[4 * start : 4 * (start + step)]))

    def _take(self, level: int) -> list[Piece]:
        self.counts[level] -= 1
        self.open -= 1
        return self.levels[level].pop()

    def _put(self, pieces: list[Piece], level: int) -> None:
        if level == self.window:
            self.closed.append(pieces)
        else:
            self.levels.setdefault(level, []).append(pieces)
            self.counts[level] += 1
            self.open += 1

    def fill_up(self) -> list[Piece]:
        """Cut the emptiest windows to fill the fullest; returns what fills no window and is kept open."""
        windows = [w for level in sorted(self.levels) for w in self.levels[level]]
        self.levels, self.open = {}, 0
        self.counts[:] = 0
        spare: list[Piece] = []
        first, last = 0, len(windows) - 1
        while first <= last:
            target, last = windows[last], last - 1
            room = self.window - sum(len(p[3]) for p in target) // 4
            while room:
                if not spare:
                    if first > last:
                        break
                    spare, first = list(windows[first]), first + 1
                head, tail = cut(spare.pop(), room)
                target.append(head)
                room -= len(head[3]) // 4
                if tail:
                    spare.append(tail)
            if room:
                spare = target
            else:
                self.closed.append(target)
        if spare:
            self._put(spare, sum(len(p[3]) for p in spare) // 4)
        return spare

    def finish(self) -> None:
        """Close everything; the rest goes to windows with a power of two of ids."""
        rest = list(self.fill_up())
        self.levels, self.open = {}, 0
        self.counts[:] = 0
        size = sum(len(p[3]) for p in rest) // 4
        while size:
            room = 1 << (size.bit_length() - 1)
            size -= room
            target: list[Piece] = []
            while room:
                head, tail = cut(rest.pop(), room)
                target.append(head)
                room -= len(head[3]) // 4
                if tail:
                    rest.append(tail)
            self.closed.append(target)


def cut(piece: Piece, size: int) -> tuple[Piece, Piece | None]:
    """The first ``size`` ids of a piece, and the others if any."""
    document, start, total, ids = piece
    if len(ids) <= 4 * size:
        return piece, None
    return (document, start, total, ids[: 4 * size]), (document, start + size, total, ids[4 * size :])


#: The pre-tokens of byte-level vocabularies that use the default pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: White space as the pattern has it. Runs of this length are not left to the pattern, which
#: would go back over all of them.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
LONG_RUN = 10_000
LONG_BLANKS = re.compile(f"[{BLANK}]{{{LONG_RUN},}}")


class Encoder:
    """Ids of a byte-level vocabulary file of the ``tokenizers`` library.

    In such a file ids stand in the order of merges, so that they serve as ranks of
    ``tiktoken``, which gives the same ids in a third of the time. The tests hold
    both against each other.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        if told["pre_tokenizer"]["type"] != "ByteLevel" or told["pre_tokenizer"]["add_prefix_space"] or told["normalizer"]:
            raise ValueError("not a byte-level vocabulary")
        vocab, byte_of = told["model"]["vocab"], {c: b for b, c in enumerate(byte_characters())}
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        ranks = {bytes(map(byte_of.__getitem__, w)): i for w, i in vocab.items() if w not in special}
        if any(vocab[a + b] != 256 + k for k, (a, b) in enumerate(told["model"]["merges"])):
            raise ValueError("ids do not stand in the order of merges")
        self.coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = set(special)
        self.end = np.array([END_ID], "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text and its end, 32 bits each."""
        return [self.ids(t) + self.end for t in texts]

    def ids(self, text: str) -> bytes:
        """Ids of a text. Of a long run of blanks, the last one belongs to what follows, if anything does."""
        parts, begin = [], 0
        for run in LONG_BLANKS.finditer(text) if len(text) >= LONG_RUN else ():
            whole = run.end() == len(text) or any(text.startswith(s, run.end()) for s in self.special)
            end = run.end() - (not whole)
            parts.append(self.coder.encode_to_numpy(text[begin : run.start()], allowed_special=self.special))
            parts.append(np.array(self.piece(text[run.start() : end]), "<u4"))
            begin = end
        parts.append(self.coder.encode_to_numpy(text[begin:], allowed_special=self.special))
        return b"".join([p.astype("<u4").tobytes() for p in parts])

    def piece(self, text: str) -> list[int]:
        """Ids of a text that is one pre-token."""
        return self.coder._core_bpe.encode_single_piece(text.encode("utf-8"))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pack(docs: DataFrame, path: str, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of a document: where it lies, and its ids.

    Columns: ``key``, ``start`` (ids of the document before the piece), ``length``,
    ``doc_tokens`` (all ids of the document, its end included), ``sequence_id``,
    ``offset`` (ids before the piece in its sequence) and ``piece_ids`` (32 bits each,
    little-endian). A null or empty text is its end id alone. Repeated rows are packed
    each. Other columns of ``docs`` are not read. An empty table gives no rows. The
    vocabulary file must lie at ``path`` on every executor.

    Sequence ids hold the number of the task, which reads the same rows whenever it
    is run again.
    """
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    kind = rows.schema[0].dataType
    schema = f"`{key}` {kind.simpleString()}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, piece_ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer = encoder(path), LevelPacker(window)
        number = TaskContext.get().partitionId() << 33
        key_type = None

        def shown(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal number
            if len(packer.closed) < least:
                return
            closed, packer.closed = packer.closed, []
            rows: list[tuple] = []
            for pieces in closed:
                offset = 0
                for document, start, total, ids in pieces:
                    rows.append((document, start, len(ids) // 4, total, number, offset, ids))
                    offset += len(ids) // 4
                number += 1
            for begin in range(0, len(rows), ROWS_PER_BATCH):
                columns = list(zip(*rows[begin : begin + ROWS_PER_BATCH], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], key_type), *(pa.array(c, pa.int64()) for c in columns[1:6]), pa.array(columns[6], pa.binary())],
                    [key, "start", "length", "doc_tokens", "sequence_id", "offset", "piece_ids"],
                )

        for batch in batches:
            key_type = batch.column(0).type
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                coded = own.encode(part.column(1).to_pylist())
                for document, ids in zip(part.column(0).to_pylist(), coded, strict=True):
                    packer.add(document, ids)
                yield from shown(1000)
        if key_type is not None:
            packer.finish()
            yield from shown(1)

    return rows.mapInArrow(run, schema)


def placed(docs: DataFrame, path: str) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pack(docs, path).select(
        "doc_id", "start", "length", F.crc32("piece_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )

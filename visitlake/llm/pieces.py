"""Encoding and decoding with a merge-type sentencepiece model (operator 6).

Every prefix of a word has one last token in its encoding. So a word is encoded
from left to right by a table of last tokens: the automaton names the tokens that
end at a character, and the right one is the one compatible with the last token of
the prefix before it. The ids are then read off the table backwards.

No piece holds a word mark after another character, hence text falls apart at the
marks into words that are encoded alone, and a word met before costs one lookup.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Words a worker remembers; it starts anew beyond. Changes no result.
REMEMBERED = 250_000
#: Answers on pairs of tokens that a worker keeps, about 100 bytes each.
REMEMBERED_PAIRS = 500_000
LONGEST_REMEMBERED = 64
NEVER = float("inf")


class PieceModel:
    """The vocabulary of a model file, with exact encoding of single words."""

    def __init__(self, path: str):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [library.id_to_piece(i) for i in range(library.get_piece_size())]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) for i in range(len(self.pieces))]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.bytes = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # a better score is merged earlier; single characters are never the outcome of a merge
        self.rank = [-1.0 if len(p) == 1 else -library.get_score(i) for i, p in enumerate(self.pieces)]
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if not piece.startswith(MARK * 2):
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.lengths = [len(p) for p in self.pieces]
        self.shown = [p.replace(MARK, " ").encode() for p in self.pieces]
        for b, i in enumerate(self.bytes):
            self.shown[i] = bytes([b])
        self.breaks = "\n" not in self.ids  # nothing is merged across a line break
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}  # by both tokens as one number
        if any(MARK in p.lstrip(MARK) for p in self.ids) or not {c for p in self.ids for c in p} <= self.ids.keys():
            raise ValueError("a piece holds an inner word mark or a character that is no piece")

    def merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Symbols of ``text`` after all merges, by definition, and the halves of the last one."""
        symbols, after, before = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list[tuple[float, int, str, int]] = []
        last = None

        def offer(left: int) -> None:
            right = after[left] if left >= 0 else len(symbols)
            if right < len(symbols):
                both = symbols[left] + symbols[right]
                if (i := self.ids.get(both)) is not None:
                    heapq.heappush(heap, (self.rank[i], left, both, right))

        for k in range(len(symbols) - 1):
            offer(k)
        while heap:
            _, left, both, right = heapq.heappop(heap)
            if not symbols[left] or after[left] != right or symbols[left] + symbols[right] != both:
                continue
            last = (symbols[left], symbols[right])
            symbols[left], symbols[right] = both, ""
            after[left] = after[right]
            if after[right] < len(symbols):
                before[after[right]] = left
            offer(left)
            offer(before[left])
        return [s for s in symbols if s], last

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens a token is made of; (-1, -1) for a character, None if merging never makes it."""
        if token not in self.halves:
            symbols, last = self.merged(self.pieces[token])
            made = (-1, -1) if len(self.pieces[token]) == 1 else tuple(self.ids[x] for x in last) if len(symbols) == 1 else None
            self.halves[token] = made
        return self.halves[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay apart when their joined text is encoded.

        Both are taken apart again, the later made first. At each step the symbols
        that touch may have been joined before either became part of something larger.
        """
        one, two, one_gone, two_gone = left, right, NEVER, NEVER
        apart = True
        while True:
            both = self.ids.get(self.pieces[one] + self.pieces[two])
            if both is not None and self.rank[both] < one_gone and self.rank[both] <= two_gone:
                apart = False
                break
            if self.rank[one] < 0 and self.rank[two] < 0:
                break
            if self.rank[one] > self.rank[two]:
                one_gone, one = self.rank[one], self.split(one)[1]
            else:
                two_gone, two = self.rank[two], self.split(two)[0]
        if len(self.pairs) >= REMEMBERED_PAIRS:
            self.pairs.clear()
        self.pairs[left * len(self.pieces) + right] = apart
        return apart

    def word(self, text: str) -> list[int]:
        """Ids of a text that has a word mark at its beginning at most."""
        last = [-1] * len(text)  # -1: a character that is no piece
        pairs, width, halves = self.pairs, len(self.pieces), self.halves
        for end, (token, length) in self.automaton.iter(text):
            if last[end] >= 0 or (halves[token] if token in halves else self.split(token)) is None:
                continue
            start = end - length
            if start >= 0 and (before := last[start]) >= 0:
                apart = pairs.get(before * width + token)
                if not (self.compatible(before, token) if apart is None else apart):
                    continue
            last[end] = token
        ids, end = [], len(text) - 1
        while end >= 0:
            if last[end] < 0:
                ids.extend(self.bytes[b] for b in reversed(text[end].encode("utf-8")))
                end -= 1
            else:
                ids.append(last[end])
                end -= self.lengths[last[end]]
        return ids[::-1]

    def keyed(self, key: str) -> list[int]:
        """Ids of a word and the blanks before it, the one blank that always stands there left out.

        All runs of marks have the same, lowest score: they are joined last, after the
        word has taken its own mark or not.
        """
        word = key.lstrip(" ")
        ids, blanks = (self.word(MARK + word), len(key) - len(word)) if word else ([], len(key) + 1)
        if word and blanks and ids[0] == self.ids[MARK]:
            ids, blanks = ids[1:], blanks + 1
        return [self.ids[x] for x in self.merged(MARK * blanks)[0]] + ids if blanks else ids

    def decode(self, ids: list[int]) -> str:
        """Text of the ids of a whole text, whose first piece begins with a mark that is not part of it."""
        return b"".join(map(self.shown.__getitem__, ids)).decode("utf-8", "replace")[1:]


class PieceCoder:
    """Whole texts, word by word, with words met before remembered.

    Words are kept in two generations: when the younger one is full it becomes the
    older, and the older one is forgotten.
    """

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.starts: dict[str, bytes] = {}
        self.line_break = np.array([self.model.bytes[10]], "<i4").tobytes()

    @staticmethod
    def keys(text: str) -> list[str]:
        parts = text.replace(MARK, " ").split(" ")
        if "" not in parts:
            return parts
        keys, blanks = [], 0
        for k, part in enumerate(parts):
            if part or k == len(parts) - 1:
                keys.append(" " * blanks + part)
                blanks = 0
            else:
                blanks += 1
        return keys

    def learn(self, key: str) -> bytes:
        """Ids of a key; one with line breaks is put together from the words between them."""
        known = self.known.get(key)
        if known is None and (known := self.older.get(key)) is None:
            if self.model.breaks and "\n" in key:
                first, *lines = key.split("\n")
                return self.learn(first) + b"".join([self.line_break + self.line_start(x) for x in lines])
            known = np.array(self.model.keyed(key), "<i4").tobytes()
        if len(key) <= LONGEST_REMEMBERED:
            self.known[key] = known
        return known

    def line_start(self, word: str) -> bytes:
        """Ids of a word without a mark before it."""
        known = self.starts.get(word)
        if known is None:
            known = np.array(self.model.word(word), "<i4").tobytes()
            if len(word) <= LONGEST_REMEMBERED:
                self.starts[word] = known
        return known

    def code(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text."""
        if not text:
            return b""
        keys = self.keys(text)
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        if len(self.starts) > REMEMBERED // 2:
            self.starts.clear()
        try:
            return b"".join(map(self.known.__getitem__, keys))
        except KeyError:
            return b"".join([known if (known := self.known.get(k)) is not None else self.learn(k) for k in keys])


@lru_cache(maxsize=2)
def coder(path: str) -> PieceCoder:
    return PieceCoder(path)


def encode(docs: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``piece_ids`` (array of int) and ``decoded`` (their text).

    A null text counts as an empty one, which has no ids. Rows may repeat: each gives
    its own row. Other columns of ``docs``, whatever their names, are not read. The
    model file must lie at ``model_path`` on every executor.
    """
    rows = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("__text"))
    kept = rows.drop("__text").schema
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields], "piece_ids array<int>", "decoded string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(model_path)
        for batch in batches:
            coded = [np.frombuffer(own.code(x), "<i4") for x in batch.column(len(kept)).to_pylist()]
            ends = np.array([0, *accumulate(map(len, coded))], "i4")
            ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(coded) if coded else np.zeros(0, "<i4")))
            columns = [*batch.columns[: len(kept)], ids, pa.array([own.model.decode(x.tolist()) for x in coded], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*kept.names, "piece_ids", "decoded"])

    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Number of ids, digest of the ids and digest of the decoded text for every document."""
    return encode(docs, model_path).select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("piece_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )

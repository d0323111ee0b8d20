"""Counting tokens of a byte-pair vocabulary without making them (operator 10).

Pre-tokens not met before are held together as one ragged array of symbols. In each
round every sequence applies its own lowest-ranked pair, all sequences at once; a
sequence without a known pair is done, and the symbols left are its tokens.

A pair whose halves are made by pairs of lower rank cannot become possible before
those are all applied, so that one pair at all its places at once gives the same
symbols as one merge at a time. The few pairs that make half of a pair of still
lower rank are applied at their first place only, and the others wait a round.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

REMEMBERED = 1_000_000
LONGEST_REMEMBERED = 64
BATCH_SYMBOLS = 2_000_000
#: Longer words are merged alone, as they need many rounds.
LONG_WORD = 400
NO_PAIR = np.iinfo(np.int32).max
#: Lower case of one character may depend on its neighbours only for this one.
FINAL_SIGMA = "Σ"


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


def unassigned() -> np.ndarray:
    """Marks the code points that Python's character tables do not know."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])


class TokenCounter:
    """A vocabulary file with word ends: counts tokens of whole texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, ending = told["model"], told["model"]["end_of_word_suffix"]
        patterns = [p["pattern"]["Regex"] for p in told["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        kinds = [n["type"] for n in told["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not ending or len(patterns) != 1 or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("not a vocabulary of lower-cased words with word ends")
        self.pattern = regex.compile(patterns[0])
        self.blank = regex.compile(r"\s+")
        names = [t["content"] for t in told["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(names, key=len, reverse=True)))) if names else None
        self.special_starts = tuple({n[:2] for n in names})
        vocab = model["vocab"]
        self.inner = np.array([vocab[c] for c in byte_characters()], np.int32)
        self.final = np.array([vocab[c + ending] for c in byte_characters()], np.int32)
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]]
        left, right, made = (np.array(x, np.int64) for x in zip(*merges, strict=True))
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = made.astype(np.int32)  # by rank
        earliest = np.full(max(vocab.values()) + 1, NO_PAIR, np.int64)  # first pair that a symbol is half of
        np.minimum.at(earliest, left, np.arange(len(left)))
        np.minimum.at(earliest, right, np.arange(len(left)))
        self.one_by_one = earliest[made] < np.arange(len(made))
        self.known: dict[str, int] = {}
        self.newer = unassigned()
        self.library = Tokenizer.from_file(path)
        self.byte_of = {c: b for b, c in enumerate(byte_characters())}

    @staticmethod
    def lower(text: str) -> str:
        """Lower case character by character, as the vocabulary's normaliser has it."""
        return "".join(c.lower() for c in text) if FINAL_SIGMA in text else text.lower()

    def words(self, text: str) -> list[str]:
        """Normalised pre-tokens of a text without special strings.

        The library's own rules are asked where a text has characters newer than
        Python's tables, as the two may disagree on which of them are letters.
        """
        if not text.isascii():
            if self.newer[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any():
                pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
                return [bytes(map(self.byte_of.__getitem__, p)).decode("utf-8") for p, _ in pieces]
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
        return self.pattern.findall(self.lower(self.blank.sub(" ", text)))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, and NO_PAIR where there is none."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_PAIR)

    def merge(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of every word after all merges."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = self.inner[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(sizes) - 1
        lasts = np.array([w[-1] for w in words], np.uint8)
        symbols[ends] = self.final[lasts]
        owner = np.repeat(np.arange(len(words)), sizes)
        counts = np.zeros(len(words), np.int64)
        while len(symbols):
            inside = owner[1:] == owner[:-1]
            ranks = np.full(len(symbols), NO_PAIR, np.int32)
            ranks[:-1][inside] = self.rank(symbols[:-1][inside], symbols[1:][inside])
            starts = np.flatnonzero(np.r_[True, ~inside])
            lengths = np.diff(np.r_[starts, len(symbols)])
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == NO_PAIR
            counts[owner[starts[done]]] = lengths[done]
            chosen = (ranks == np.repeat(lowest, lengths)) & (ranks != NO_PAIR)
            chosen = self._apart(chosen)
            places = np.flatnonzero(chosen)
            later = np.r_[False, owner[places[1:]] == owner[places[:-1]]] if len(places) else np.zeros(0, bool)
            chosen[places[later & self.one_by_one[ranks[places]]]] = False
            symbols[chosen] = self.made[ranks[chosen]]
            keep = np.repeat(~done, lengths)
            keep[1:] &= ~chosen[:-1]
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def merge_long(self, word: bytes) -> int:
        """Symbols left of one long word: a round touches only the places of its pair.

        Symbols are linked to their neighbours, and places are kept by the rank of the
        pair that begins there, so that many rounds over a long word do not each look at
        all of it.
        """
        size = len(word)
        symbols = self.inner[np.frombuffer(word, np.uint8)]
        symbols[-1] = self.final[word[-1]]
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        ranks = np.full(size + 1, NO_PAIR, np.int32)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []
        left = size

        def offer(places: np.ndarray) -> None:
            """Rank the pairs that begin at some places anew."""
            has = after[places] < size
            ranks[places[~has]] = NO_PAIR
            places = places[has]
            found = self.rank(symbols[places], symbols[after[places]])
            ranks[places] = found
            known = found != NO_PAIR
            places, found = places[known], found[known]
            order = np.argsort(found, kind="stable")
            places, found = places[order], found[order]
            if not len(found):
                return
            begins = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]).tolist()
            for a, b in zip(begins, [*begins[1:], len(found)], strict=True):
                rank = int(found[a])
                if rank not in waiting:
                    waiting[rank] = []
                    heapq.heappush(heap, rank)
                waiting[rank].append(places[a:b])

        offer(np.arange(size))
        while heap:
            rank = heapq.heappop(heap)
            places = np.unique(np.concatenate(waiting.pop(rank)))
            places = places[ranks[places] == rank]
            if not len(places):
                continue
            if self.one_by_one[rank] and len(places) > 1:
                waiting[rank] = [places[1:]]
                heapq.heappush(heap, rank)
                places = places[:1]
            # of places that follow one another, as in 'aaaa', the first, third, ...
            follows = np.r_[False, after[places[:-1]] == places[1:]]
            if follows.any():
                number = np.arange(len(places))
                begin = np.maximum.accumulate(np.where(follows, -1, number))
                places = places[(number - begin) % 2 == 0]
            gone = after[places]
            symbols[places] = self.made[rank]
            ranks[gone] = NO_PAIR
            behind = after[gone]
            after[places] = behind
            inside = behind < size
            before[behind[inside]] = places[inside]
            left -= len(places)
            front = before[places]
            offer(np.unique(np.r_[places, front[front >= 0]]))
        return left

    @staticmethod
    def _apart(chosen: np.ndarray) -> np.ndarray:
        """Of neighbouring places in a run (as in 'aaaa'), the first, third, ... only."""
        if not (chosen[1:] & chosen[:-1]).any():
            return chosen
        place = np.arange(len(chosen))
        begin = np.maximum.accumulate(np.where(chosen & ~np.r_[False, chosen[:-1]], place, -1))
        return chosen & ((place - begin) % 2 == 0)

    def pre_tokens(self, text: str) -> tuple[int, list[str]]:
        """Number of special strings in the text, and the words between them."""
        parts, special = [text], 0
        if self.special and any(s in text for s in self.special_starts):
            parts = self.special.split(text)
            special = len(parts) - 1
        words: list[str] = []
        for part in parts:
            words.extend(self.words(part))
        return special, words

    def learn(self, words: set[str]) -> dict[str, int]:
        """Counts of words, a bounded number of symbols at a time."""
        found: dict[str, int] = {}
        batch: list[str] = []
        size = 0
        for word in words:
            if len(word) > LONG_WORD:
                found[word] = self.merge_long(word.encode("utf-8"))
                continue
            batch.append(word)
            size += len(word)
            if size > BATCH_SYMBOLS:
                found.update(zip(batch, self.merge([w.encode("utf-8") for w in batch]).tolist(), strict=True))
                batch, size = [], 0
        if batch:
            found.update(zip(batch, self.merge([w.encode("utf-8") for w in batch]).tolist(), strict=True))
        return found

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        split = [self.pre_tokens(t) for t in texts]
        new = {w for _, words in split for w in words if w not in self.known}
        found = self.learn(new)
        self.known.update((w, n) for w, n in found.items() if len(w) <= LONGEST_REMEMBERED)
        long = {w: n for w, n in found.items() if len(w) > LONGEST_REMEMBERED}
        if long:
            return [special + sum(self.known[w] if w in self.known else long[w] for w in words) for special, words in split]
        return [special + sum(map(self.known.__getitem__, words)) for special, words in split]


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(
    docs: DataFrame, path: str, limit: int = 2048, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    A null text counts as an empty one: no bytes, no tokens. Repeated rows each give
    their own row; other columns of ``docs`` are not read. Special strings inside a
    text are one token each. The vocabulary file must lie at ``path`` on every executor.
    """
    rows = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("__text"))
    kept = rows.drop("__text").schema
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields], "n_bytes bigint", "n_tokens bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            texts = batch.column(len(kept))
            sizes = pc.binary_length(texts).cast(pa.int64())
            counts: list[int] = []
            for start in range(0, len(texts), 500):
                counts.extend(own.count(texts.slice(start, 500).to_pylist()))
            columns = [*batch.columns[: len(kept)], sizes, pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept.names, "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)

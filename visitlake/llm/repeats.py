"""Runs of words that repeat with a period, and texts without the repetitions (operator 13).

A run of at least ``exponent`` periods holds that many places of the grid of multiples
of its period, with the same word at all of them. Every period's grid is looked at, in
all as many places as the sum of n/p, and where such a chain of equal words stands the
run is measured to both sides by longest common extensions. Texts are handled many at a
time, as one array of numbered words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.extensions import Extensions

#: A run holds this many periods and this many words at least.
EXPONENT = 4
LEAST = 6
#: Places of grids looked at together.
GRID_PLACES = 1_500_000
#: Different words that a task numbers before it begins anew.
NUMBERED_WORDS = 1_000_000
#: Shorter runs are not remembered as places that need no second look.
LONG_RUN = 64
WORD = r"[^\x20\x09-\x0D]+"

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # start, end, period


class Numbers(dict):
    """Numbers for words, in the order in which they are first met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def grid_places(size: int, exponent: int) -> int:
    """How many places the grids of all periods of a text have, from above."""
    return int(size * (1 + np.log(max(1, size // exponent)))) if size >= exponent else 0


class Searcher:
    """Texts laid behind one another, each with an end of its own."""

    def __init__(self, texts: list[np.ndarray], exponent: int, least: int):
        self.exponent, self.least = exponent, least
        self.sizes = np.array([len(t) for t in texts], np.int64)
        top = max((int(t.max(initial=0)) for t in texts), default=0) + 1
        self.starts = np.r_[0, np.cumsum(self.sizes + 1)[:-1]].astype(np.int64)
        self.numbers = np.concatenate([np.r_[t, top + k] for k, t in enumerate(texts)]) if texts else np.zeros(0, np.int64)
        self.numbers = self.numbers.astype(np.int64)
        periods = np.where(self.sizes >= least, self.sizes // exponent, 0)
        self.text = np.repeat(np.arange(len(texts)), periods)
        self.period = np.arange(len(self.text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
        self.places = (self.sizes[self.text] - 1) // self.period - exponent + 2

    def blocks(self) -> Iterator[tuple[int, int]]:
        """Ranges of texts' periods of a bounded number of places, but for single ones."""
        total = np.cumsum(self.places)
        begin = 0
        while begin < len(total):
            before = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + GRID_PLACES, "right")))
            yield begin, end
            begin = end

    def chains(self, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, place and period of every chain of equal words on the grids of some periods."""
        places = self.places[begin:end]
        owner = np.repeat(np.arange(begin, end), places)
        period = self.period[owner]
        at = (np.arange(len(owner)) - np.repeat(np.cumsum(places) - places, places)) * period + self.starts[self.text[owner]]
        for k in range(1, self.exponent):
            same = self.numbers[at] == self.numbers[at + k * period]
            at, period, owner = at[same], period[same], owner[same]
        return self.text[owner], at, period

    def search(self) -> list[Runs]:
        """Runs of every text by start, then period."""
        found: list[np.ndarray] = []
        seen_end = np.zeros(len(self.numbers), np.int64)
        seen_period = np.ones(len(self.numbers), np.int64)
        ahead = None
        for begin, end in self.blocks():
            text, at, period = self.chains(begin, end)
            new = (at + period >= seen_end[at]) | (period % seen_period[at] != 0)
            text, at, period = text[new], at[new], period[new]
            if not len(at):
                continue
            if ahead is None or not set(text.tolist()) <= chosen:
                chosen = set(text.tolist())
                offsets, ahead, back = self._extensions(sorted(chosen))
            near = at + offsets[text]
            right = ahead.between(near, near + period)
            left = back.between(ahead.size - near - period, ahead.size - near)
            first, last = at - left, at + period + right
            long = last - first >= np.maximum(self.least, self.exponent * period)
            runs = np.unique(np.stack([text[long], first[long], last[long], period[long]]), axis=1)
            found.append(runs)
            for _, a, b, p in runs[:, runs[2] - runs[1] >= LONG_RUN].T.tolist():
                inner = slice(a, b)
                longer = seen_end[inner] < b
                seen_end[inner][longer] = b
                seen_period[inner][longer] = p
        return self._by_text(found)

    def _extensions(self, texts: list[int]) -> tuple[np.ndarray, Extensions, Extensions]:
        """Extensions over some of the texts, forward and backward, and how far each text moved."""
        parts = [self.numbers[self.starts[t] : self.starts[t] + self.sizes[t] + 1] for t in texts]
        offsets = np.zeros(len(self.sizes), np.int64)
        offsets[texts] = np.r_[0, np.cumsum([len(p) for p in parts])[:-1]] - self.starts[texts]
        chosen = np.concatenate(parts)
        _, small = np.unique(chosen, return_inverse=True)
        return offsets, Extensions(small), Extensions(small[::-1])

    def _by_text(self, found: list[np.ndarray]) -> list[Runs]:
        nothing = np.zeros(0, np.int64)
        runs: list[Runs] = [(nothing, nothing, nothing)] * len(self.sizes)
        if not any(f.size for f in found):
            return runs
        every = np.concatenate(found, axis=1)
        # of one stretch, the smallest period; all others are multiples of it
        every = every[:, np.lexsort((every[3], every[2], every[1], every[0]))]
        every = every[:, np.r_[True, (np.diff(every[:3], axis=1) != 0).any(axis=0)]]
        every = every[:, np.lexsort((every[3], every[1], every[0]))]
        texts, begins = np.unique(every[0], return_index=True)
        for t, a, b in zip(texts.tolist(), begins.tolist(), [*begins.tolist()[1:], every.shape[1]], strict=True):
            runs[t] = (every[1, a:b] - self.starts[t], every[2, a:b] - self.starts[t], every[3, a:b])
        return runs


def runs_of(texts: list[np.ndarray], exponent: int = EXPONENT, least: int = LEAST) -> list[Runs]:
    """Maximal runs of every array of numbered words: starts, ends and smallest periods."""
    return Searcher(texts, exponent, least).search()


def kept_words(size: int, runs: Runs) -> np.ndarray:
    """Marks the words that no run repeats: all but those behind a run's first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[0] + runs[2], 1)
    np.add.at(change, runs[1], -1)
    return np.cumsum(change[:-1]) == 0


def collapse(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), exponent: int = EXPONENT, least: int = LEAST
) -> DataFrame:
    """``keep`` columns with ``runs`` and ``collapsed``, the text without repetitions, its words joined by blanks.

    ``runs`` is an array of start (word number), length and period, by start, then
    period: every stretch of words with smallest period q, at least ``exponent`` times q
    and ``least`` words long, that can be made longer to neither side. A word is left
    out if a run holds it behind the run's first q words. A null, empty or blank text
    has no runs and the empty text left. Repeated rows give equal rows each, an empty
    table none; other columns are not read. A text of any length is handled whole, in
    memory proportional to it.
    """
    if exponent < 2:
        raise ValueError("a run holds two periods at least")
    rows = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__text"))
    kept = docs.select(*keep).schema
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields]
    schema = ", ".join([*columns, "runs array<struct<start:bigint,length:bigint,period:bigint>>", "collapsed string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        for batch in batches:
            texts = batch.column(len(kept))
            begin, places, held, coded = 0, 0, [], []
            for k in range(len(texts)):
                words = texts[k].as_py().split()
                held.append(words)
                coded.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                places += grid_places(len(words), exponent)
                if places > GRID_PLACES or len(numbers) > NUMBERED_WORDS or k == len(texts) - 1:
                    told = _told(held, runs_of(coded, exponent, least))
                    part = batch.slice(begin, k + 1 - begin)
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *told], [*kept.names, "runs", "collapsed"])
                    begin, places, held, coded = k + 1, 0, [], []
                    if len(numbers) > NUMBERED_WORDS:
                        numbers.clear()

    return rows.mapInArrow(run, schema)


def _told(held: list[list[bytes]], found: list[Runs]) -> list[pa.Array]:
    """The two result columns of some texts."""
    left = []
    for words, runs in zip(held, found, strict=True):
        if len(runs[0]):
            words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist()]
        left.append(b" ".join(words))
    starts, ends, periods = (np.concatenate([r[k] for r in found]) for k in range(3))
    told = pa.StructArray.from_arrays([pa.array(starts), pa.array(ends - starts), pa.array(periods)], ["start", "length", "period"])
    places = np.cumsum([0, *[len(r[0]) for r in found]]).astype(np.int32)
    return [pa.ListArray.from_arrays(pa.array(places), told), pa.array(left, pa.binary()).view(pa.string())]


def looped(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where one document in ten repeats a part of itself from some word on.

    Which, from where and how long the part is follow from the id. Such a text's words
    stand between single blanks.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), 1)
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words")
    start = F.col("g") % F.greatest(n, F.lit(1))
    period = 1 + F.floor((n - start) / (3 + F.col("g") % 8))
    part = F.slice("words", start.cast("int") + 1, period.cast("int"))
    times = F.ceil((n - start) / period).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(part, times)), F.lit(1), (n - start).cast("int"))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), start.cast("int")), tail), " ")
    return chosen.select("doc_id", F.when(n > 0, made).otherwise(F.col("text")).alias("text"))


def digests(docs: DataFrame) -> DataFrame:
    """Runs of every document, one in ten looped: their number, the longest one, and digests."""
    rows = collapse(looped(docs))
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    # greatest length first, then smallest start and period
    best = F.aggregate(
        "runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda a, r: F.when(a.isNull() | (r["length"] > a["length"]), r).otherwise(a),
    )
    told = rows.select("doc_id", "runs", "collapsed", best.alias("best"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return told.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

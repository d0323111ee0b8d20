"""Text quality from supervised subword embeddings (operator 3).

A document is the average of the vectors of its words, of their character n-grams and
of its word pairs, all hashed into one table; a softmax layer turns it into two
probabilities. Table and layer are learned by stochastic gradient descent in numpy
on a bounded sample of labelled documents.

As the layer is linear, every vector of a trained model can be replaced by the two
numbers it adds, and a word by the sum over its own parts. Scoring a document is then
one lookup per word, whatever the length of the vectors.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents the model is fitted on at most, per class. All others are only scored.
SAMPLE_PER_CLASS = 2500
BUCKETS = 1 << 17
WIDTH = 12
SHORTEST, LONGEST = 3, 5
#: Passes over the sample, and steps there are at least: a small sample is gone through more often.
EPOCHS, STEPS = 6, 3000
RATE = 0.5
BATCH = 8
SEED = 11
#: Longest word that is looked at piece by piece; a longer one is cut into words of this length.
WORD_LENGTH = 40
REMEMBERED = 800_000
END = "</s>"
MASK = BUCKETS - 1


def hashed(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) & MASK


def word_parts(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table places of words and of their character n-grams, the word each belongs to, and the words' own places.

    All words are laid out in one array of characters, and the n-grams of one length are
    hashed at once. Those that run across two words are left out.
    """
    own = np.array([hashed(w) for w in words], np.int64)
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters to the word's end
    places, owners = [own], [np.arange(len(words))]
    rolled = np.zeros(len(codes), np.uint64)
    for n in range(1, LONGEST + 1):
        if len(codes) < n:
            break
        rolled = (rolled[: len(codes) - n + 1] + codes[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(29)
        if n >= SHORTEST:
            inside = left[: len(rolled)] >= n
            places.append(((rolled[inside] >> np.uint64(20)) & np.uint64(MASK)).astype(np.int64))
            owners.append(owner[: len(rolled)][inside])
    return np.concatenate(places), np.concatenate(owners), own


def words_of(text: str | None) -> list[str]:
    """Words of a whole text and an end mark, so that an empty text has one, too."""
    words = (text or "").split()
    if words and max(map(len, words)) > WORD_LENGTH:
        words = [w[k : k + WORD_LENGTH] for w in words for k in range(0, len(w), WORD_LENGTH)]
    words.append(END)
    return words


def pair_places(firsts: np.ndarray) -> np.ndarray:
    """Table places of neighbouring words. A repeated word has the same place whatever it is."""
    one, two = firsts[:-1].astype(np.uint64), firsts[1:].astype(np.uint64)
    places = ((one * np.uint64(0x9E3779B97F4A7C15) + two * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(40)).astype(np.int64) & MASK
    return np.where(one == two, hashed("<same>"), places)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Table places of a whole text, and how often each occurs."""
    words = words_of(text)
    counts = Counter(words)
    places, owners, own = word_parts(list(counts))
    times = np.fromiter(counts.values(), np.int64, len(counts))[owners]
    at = dict(zip(counts, range(len(counts)), strict=True))
    pairs = pair_places(own[[at[w] for w in words]])
    together, position = np.unique(np.r_[places, pairs], return_inverse=True)
    return together.astype(np.int32), np.bincount(position, np.r_[times, np.ones(len(pairs), np.int64)]).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """What every table place adds to the difference of the two outputs, and the layer's offset."""

    gains: np.ndarray
    offset: float


def train(samples: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Fit on (places, counts, label) of documents. Without both labels nothing is learned."""
    labels = np.array([s[2] for s in samples], np.int64)
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        return Model(np.zeros(BUCKETS, np.float32), 6.0 * (2 * share - 1))
    rng = np.random.default_rng(SEED)
    table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    layer = rng.normal(0, 0.1, (WIDTH, 2)).astype(np.float32)
    offset = np.zeros(2, np.float32)
    round_steps = math.ceil(len(samples) / BATCH)
    rounds = max(EPOCHS, math.ceil(STEPS / round_steps))
    steps, step = rounds * round_steps, 0
    for _ in range(rounds):
        order = rng.permutation(len(samples))
        for start in range(0, len(order), BATCH):
            rate = RATE * (1 - step / steps)
            step += 1
            chosen = [samples[k] for k in order[start : start + BATCH]]
            docs = np.stack([(n / n.sum()) @ table[p] for p, n, _ in chosen])
            scores = docs @ layer + offset
            odds = np.exp(scores - scores.max(axis=1, keepdims=True))
            odds /= odds.sum(axis=1, keepdims=True)
            odds[np.arange(len(chosen)), [s[2] for s in chosen]] -= 1
            back = odds @ layer.T
            layer -= rate * (docs.T @ odds) / len(chosen)
            offset -= rate * odds.mean(axis=0)
            for (places, counts, _), slope in zip(chosen, back, strict=True):
                # places are distinct within a document; a document's total step does not depend on its length
                table[places] -= (rate * WIDTH * counts / np.sqrt((counts * counts).sum() * counts.sum()))[:, None] * slope
    gap = layer[:, 1] - layer[:, 0]
    return Model((table @ gap).astype(np.float32), float(offset[1] - offset[0]))


class Scorer:
    """Scores of whole texts, with words met before remembered.

    A word is a number, under which its gain, its number of parts and its own place
    stand in arrays.
    """

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.gains, self.parts, self.places = np.zeros(1024), np.zeros(1024, np.int64), np.zeros(1024, np.int64)

    def learn(self, words: list[str]) -> None:
        first, last = len(self.known), len(self.known) + len(words)
        if last > len(self.gains):
            size = 2 * last
            self.gains, self.parts, self.places = (np.r_[x, np.zeros(size - len(x), x.dtype)] for x in (self.gains, self.parts, self.places))
        places, owners, own = word_parts(words)
        self.gains[first:last] = np.bincount(owners, self.model.gains[places], len(words))
        self.parts[first:last] = np.bincount(owners, minlength=len(words))
        self.places[first:last] = own
        self.known.update(zip(words, range(first, last), strict=True))

    def scores(self, texts: list[str | None]) -> list[float]:
        if len(self.known) > REMEMBERED:
            self.forget()
        split = [words_of(t) for t in texts]
        new = {w for words in split for w in words}.difference(self.known)
        if new:
            self.learn(sorted(new))
        out = []
        for words in split:
            at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            pairs = pair_places(self.places[at])
            total = self.gains[at].sum() + self.model.gains[pairs].sum(dtype=np.float64)
            value = total / (self.parts[at].sum() + len(pairs)) + self.model.offset
            out.append(1 / (1 + math.exp(-max(-500.0, min(500.0, value)))))
        return out

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]


def _in_parts(own: Scorer, texts: pa.Array) -> pa.Array:
    """Scores of a batch, some texts at a time."""
    found: list[float] = []
    for start in range(0, len(texts), 100):
        found.extend(own.scores(texts.slice(start, 100).to_pylist()))
    return pa.array(found, pa.float64())


def held_out(key: str) -> F.Column:
    """Rows whose checksum of the id leaves 1 modulo 3: their labels are never learned from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Train on the rows of ``labels`` that are not held out.

    Of each class the ``per_class`` ids with the smallest hashes are taken: a bounded
    sample that is the same in any order of rows. Its features, not its texts, come to
    the driver. A rare class is thus not thinned out with a frequent one; the odds of the
    classes among all rows are put back by the model's offset. Null labels and labels
    other than 0 and 1 are not used. If an id has several labels, the smallest counts,
    and of several rows of an id the one with the smallest text.
    """
    usable = labels.select(key, F.col(label).cast("int").alias("label")).where(f"label in (0, 1) and {key} is not null")
    usable = usable.where(~held_out(key)).groupBy(key).agg(F.min("label").alias("label"))
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    takes = {k: min(per_class, n) for k, n in counts.items()}
    order = [F.xxhash64(F.col(key).cast("string")), F.col(key)]
    chosen = None
    for value, take in sorted(takes.items()):
        part = usable.where(F.col("label") == value).orderBy(*order).limit(take)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return train([])
    # at most 2 * per_class rows of an id and a label
    rows = docs.select(F.col(key), F.col(text).alias("__text")).join(F.broadcast(chosen), key)
    rows = rows.groupBy(key, "label").agg(F.min("__text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                places, times = features(batch.column(1)[k].as_py())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), pa.array([places.tobytes()], pa.binary()), pa.array([times.tobytes()], pa.binary()), batch.column(2).slice(k, 1)],
                    ["id", "places", "times", "label"],
                )

    kind = rows.schema[key].dataType.simpleString()
    told = rows.select(key, "__text", "label").mapInArrow(run, f"id {kind}, places binary, times binary, label int")
    samples = sorted(told.collect(), key=lambda r: (r["id"], bytes(r["places"]), bytes(r["times"])))
    model = train([(np.frombuffer(r["places"], np.int32), np.frombuffer(r["times"], np.float32), r["label"]) for r in samples])
    if len(counts) < 2:
        return model
    return Model(model.gains, model.offset + math.log(counts[1] / takes[1]) - math.log(counts[0] / takes[0]))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` rows as ``key``, ``score`` (0 to 1, higher: better) and ``predicted`` (1 from 0.5 on).

    Whole texts are scored, null ones as empty. Nothing but the text is looked at.
    Repeated rows each give their own row.
    """
    rows = docs.select(F.col(key), F.col(text).alias("__text"))
    kind = rows.schema[key].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast((model.gains, model.offset))  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(Model(*sent.value))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _in_parts(own, batch.column(1))], [key, "score"])

    return rows.mapInArrow(run, f"`{key}` {kind}, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def kept(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns unchanged, whose text is predicted to be of class 1."""
    sent = docs.sparkSession.sparkContext.broadcast((model.gains, model.offset))
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(Model(*sent.value))
        for batch in batches:
            yield batch.filter(pc.greater_equal(_in_parts(own, batch.column(place)), 0.5))

    return docs.mapInArrow(run, docs.schema)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with its score, and whether its label was held out."""
    return score(docs, fit(docs, labels)).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")

"""Similarity join of documents by the Jaccard coefficient of their word shingles (operator 8).

1. Equal shingle sets are one class, with its smallest document standing for it.
2. Signature trees find the pairs: nodes hold the OR of their sets' token bitmaps and
   the range of their sizes, and walking two trees at once, a pair of nodes is left
   when even the largest overlap these allow is too small.
3. Which classes share a tree is a matter of buckets, as one task cannot hold all. A
   bucket is a band of three minima of hashed shingles; there are as many bands as make
   the chance that two linked sets share none less than ``MISS``.
4. Trees are walked in three rounds, so that a group of copies of any size costs a pair
   per member. First every class of a block is paired with the nearest smaller one that
   a tree leaves it. Then one class of every component that a bucket still holds is
   paired likewise. Last, buckets that still hold several components are searched whole,
   in pairs of blocks.
5. Every pair is decided by its whole sets. The last round does so in the task that
   finds the pair, and hands out no pair but links between components. Links between
   documents are never guessed, and components are joined from links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from visitlake.llm.blocks import PLACE, deal, deal_within, gathered
from visitlake.llm.components import components, stored

WORDS = 5
PERCENT = 80
#: Chance that a pair exactly at the similarity wanted meets in no bucket.
MISS = 1e-9
MINIMA = 3
BITS = 2048
LEAF = 16
FANOUT = 8
#: Classes of a bucket that one task compares at a time; larger buckets are dealt out in blocks.
BLOCK = 1024
#: The same for the first two rounds, in which blocks do not meet each other.
NEAR_BLOCK = 512
#: Shared buckets of a class, in the order of bands, in which the first round looks for its nearest class.
NEAR_BANDS = 4
REMEMBERED = 400_000
SEED = 20240607


def bands(percent: int) -> int:
    """Bands needed so that a pair at the similarity meets with a chance of 1 - MISS."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** MINIMA))


class Shingler:
    """Hashed shingles of whole texts."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}
        odd = np.random.default_rng(SEED).integers(1, 2**63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.factors = odd

    def hashes(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit shingles; a text with fewer words is one shingle."""
        words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z and the blanks of ASCII count
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        try:
            ids = list(map(known.__getitem__, words))
        except KeyError:
            for word in set(words):
                if word not in known:
                    known[word] = xxhash.xxh3_64_intdigest(word)
            ids = list(map(known.__getitem__, words))
        one = np.array(ids, np.uint64)
        size = min(self.words, len(one))
        out = np.full(len(one) - size + 1, size, np.uint64)
        for k in range(size):
            out = _mixed(out * self.factors[k] + one[k : len(one) - size + 1 + k])
        return np.unique(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _factors(count: int) -> np.ndarray:
    rng = np.random.default_rng(SEED + 1)
    return rng.integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the set."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, 400_000 // len(factors))
    for start in range(0, len(hashes), step):
        part = hashes[start : start + step]
        values = part[:, None] * factors[None, :]
        values ^= values >> np.uint64(31)
        np.minimum(least, (values * np.uint64(0xBF58476D1CE4E5B9)).min(axis=0), out=least)
    return least


def bitmap(hashes: np.ndarray) -> bytes:
    bits = np.zeros(BITS, np.uint8)
    bits[(hashes >> np.uint64(40)).astype(np.int64) % BITS] = 1
    return np.packbits(bits).tobytes()


def shingle_sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """What is known of every row's set: size, digest, bitmap with its surplus, and a bucket per band.

    A set of no shingles has a null digest. ``docs`` has the columns doc_id and text.
    """
    count = bands(percent)
    factors, turn = _factors(count * MINIMA), _factors(count)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n bigint, set_key binary, excess bigint, bits binary, buckets array<bigint>"
    names = ["doc_id", "n", "set_key", "excess", "bits", "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Shingler(words)
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                sizes, digests, excess, bits, buckets = [], [], [], [], []
                for text in batch.column(1).to_pylist():
                    hashes = own.hashes(text)
                    marks = bitmap(hashes)
                    sizes.append(len(hashes))
                    digests.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                    bits.append(marks)
                    excess.append(len(hashes) - int.from_bytes(marks, "big").bit_count())
                    key = np.zeros(count, np.uint64)
                    if len(hashes):
                        least = minima(hashes, factors).reshape(count, MINIMA)
                        for k in range(MINIMA):
                            key = _mixed(key * turn + least[:, k])
                    buckets.append(_mixed(key + turn).view(np.int64))
                ends = pa.array(np.arange(len(buckets) + 1, dtype=np.int32) * count)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(excess, pa.int64()),
                        pa.array(bits, pa.binary()), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(buckets))),
                    ],
                    names,
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


class SignatureTree:
    """Sets packed bottom-up: nodes with OR-ed bitmaps, size ranges and the largest surplus of tokens over bits."""

    def __init__(self, sizes: np.ndarray, excess: np.ndarray, bits: np.ndarray):
        # similar sets next to each other: by size first, then by bitmap
        self.order = np.lexsort((*[bits[:, k] for k in range(3, -1, -1)], sizes))
        low, high, extra, marks = (x[self.order] for x in (sizes, sizes, excess, bits))
        self.levels = [(low, high, extra, marks)]
        width = LEAF
        while len(low) > 1:
            starts = np.arange(0, len(low), width)
            low, high, extra = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.maximum.reduceat(extra, starts)
            marks = np.bitwise_or.reduceat(marks, starts, axis=0)
            self.levels.append((low, high, extra, marks))
            width = FANOUT

    def children(self, level: int, nodes: np.ndarray) -> list[np.ndarray]:
        width = LEAF if level == 1 else FANOUT
        return [np.arange(n * width, min((n + 1) * width, len(self.levels[level - 1][0]))) for n in nodes]


def _possible(one: tuple, two: tuple, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether the sets below two nodes may be similar enough.

    Common tokens lie on common bits; tokens that share a bit with another of their
    own set are at most the set's surplus.
    """
    fits = (100 * one[1][i] >= percent * two[0][j]) & (100 * two[1][j] >= percent * one[0][i])
    common = np.bitwise_count(one[3][i] & two[3][j]).sum(axis=1, dtype=np.int64) + np.minimum(one[2][i], two[2][j])
    common = np.minimum(common, np.minimum(one[1][i], two[1][j]))
    # the smallest sets below need the least: o / (a + b - o) >= p
    return fits & ((100 + percent) * common >= percent * (one[0][i] + two[0][j]))


def tree_pairs(one: SignatureTree, two: SignatureTree | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of sets that may be similar enough, by walking both trees at once."""
    own = two is None
    other = one if own else two
    a, b = len(one.levels) - 1, len(other.levels) - 1
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        kept = []
        for start in range(0, len(i), 50_000):
            part = slice(start, start + 50_000)
            kept.append(_possible(one.levels[a], other.levels[b], i[part], j[part], percent))
        keep = np.concatenate(kept) if kept else np.zeros(0, bool)
        i, j = i[keep], j[keep]
        if (a == 0 and b == 0) or not len(i):
            break
        if a >= b and a:
            below = one.children(a, i)
            i, j, a = np.concatenate(below), np.repeat(j, [len(x) for x in below]), a - 1
        else:
            below = other.children(b, j)
            i, j, b = np.repeat(i, [len(x) for x in below]), np.concatenate(below), b - 1
        if own and a == b:
            once = i <= j
            i, j = i[once], j[once]
    if own:
        i, j = i[i < j], j[i < j]
    return one.order[i], other.order[j]


def likeness(sizes: np.ndarray, excess: np.ndarray, bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The largest coefficient that bitmaps and sizes of two sets allow."""
    told = []
    for start in range(0, len(i), 50_000):
        one, two = i[start : start + 50_000], j[start : start + 50_000]
        common = np.bitwise_count(bits[one] & bits[two]).sum(axis=1, dtype=np.int64) + np.minimum(excess[one], excess[two])
        common = np.minimum(common, np.minimum(sizes[one], sizes[two]))
        told.append(common / (sizes[one] + sizes[two] - common))
    return np.concatenate(told) if told else np.zeros(0)


def _signatures(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, surplus and bitmaps of gathered rows of class_id, root, n, excess and bits."""
    bits = np.frombuffer(b"".join(r[8] for r in rows), np.uint64).reshape(len(rows), BITS // 64)
    return np.array([r[6] for r in rows], np.int64), np.array([r[7] for r in rows], np.int64), bits


def _ranks(keys: list) -> np.ndarray:
    """Places of keys among the distinct ones in order."""
    place = {k: n for n, k in enumerate(sorted(set(keys)))}
    return np.array([place[k] for k in keys], np.int64)


def _nearest(dealt: DataFrame, percent: int) -> DataFrame:
    """Per class ``b`` of a block, the likest smaller class ``a`` of another component that its tree leaves, and ``likeness``."""
    kind = dealt.schema["class_id"].dataType
    id_type = to_arrow_type(kind)
    schema = f"a {kind.simpleString()}, b {kind.simpleString()}, likeness double"

    def work(groups: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
        for rows in groups:
            ids, root = _ranks([r[4] for r in rows]), _ranks([r[5] for r in rows])
            if not root.any():
                continue
            known = _signatures(rows)
            i, j = tree_pairs(SignatureTree(*known), None, percent)
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
            smaller, larger = np.where(ids[i] < ids[j], i, j), np.where(ids[i] < ids[j], j, i)
            near = likeness(*known, smaller, larger)
            order = np.lexsort((-ids[smaller], near, larger))
            best = order[np.r_[larger[order][1:] != larger[order][:-1], True]] if len(order) else order
            one, two = ([rows[k][4] for k in side[best]] for side in (smaller, larger))
            yield pa.RecordBatch.from_arrays([pa.array(one, id_type), pa.array(two, id_type), pa.array(near[best], pa.float64())], ["a", "b", "likeness"])

    return gathered(dealt, ["class_id", "root", "n", "excess", "bits"], work, schema)


def _block_pairs(rows: list[tuple], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``rows`` of pairs that the trees of a block, or of two, leave, of different components."""
    root = _ranks([r[5] for r in rows])
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not root.any():
        return none
    if rows[0][1] == rows[0][2]:
        i, j = tree_pairs(SignatureTree(*_signatures(rows)), None, percent)
    else:
        sides = [np.array([k for k, r in enumerate(rows) if r[3] == side], np.int64) for side in (0, 1)]
        if not all(map(len, sides)):
            return none
        i, j = tree_pairs(*(SignatureTree(*_signatures([rows[k] for k in side])) for side in sides), percent)
        i, j = sides[0][i], sides[1][j]
    apart = root[i] != root[j]
    return i[apart], j[apart]


def _in_question(dealt: DataFrame, percent: int) -> DataFrame:
    """The rows of ``dealt`` (bucket, low, high, side, class_id) that are part of any pair the trees leave."""
    kind = dealt.schema["class_id"].dataType
    types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), to_arrow_type(kind))
    names = ["bucket", "low", "high", "side", "class_id"]

    def work(groups: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
        for rows in groups:
            marked = np.unique(np.concatenate(_block_pairs(rows, percent)))
            if len(marked):
                columns = zip(*(rows[k][:5] for k in marked), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names)

    schema = f"bucket bigint, low int, high int, side int, class_id {kind.simpleString()}"
    return gathered(dealt, ["class_id", "root", "n", "excess", "bits"], work, schema)


def _linked(dealt: DataFrame, percent: int) -> DataFrame:
    """Links (``a``, ``b``) that connect the components of a block pair, each decided by its whole sets.

    A pair whose classes are connected by then is not looked at, so that a block pair
    gives fewer links than it has rows.
    """
    kind = dealt.schema["class_id"].dataType
    id_type = to_arrow_type(kind)

    def links(rows: list[tuple]) -> list[tuple]:
        i, j = _block_pairs(rows, percent)
        if not len(i):
            return []
        sets = [np.frombuffer(r[9], np.uint64) for r in rows]
        near = likeness(*_signatures(rows), i, j)
        up = list(range(len(rows)))

        def top(k: int) -> int:
            while up[k] != k:
                up[k] = up[up[k]]
                k = up[k]
            return k

        first: dict = {}
        for k, row in enumerate(rows):
            up[k] = first.setdefault(row[5], k)
        out = []
        for k in np.argsort(-near, kind="stable"):
            one, two = int(i[k]), int(j[k])
            if top(one) != top(two) and _similar(sets[one], sets[two], percent):
                up[top(one)] = top(two)
                out.append((rows[one][4], rows[two][4]))
        return out

    def work(groups: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
        for rows in groups:
            if found := links(rows):
                yield pa.RecordBatch.from_arrays([pa.array(c, type=id_type) for c in zip(*found, strict=True)], ["a", "b"])

    columns = ["class_id", "root", "n", "excess", "bits", "tokens"]
    return gathered(dealt, columns, work, f"a {kind.simpleString()}, b {kind.simpleString()}")


def _similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * common >= percent * (len(one) + len(two) - common)


def _token_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Whole sets (``class_id``, ``tokens``) of the classes named in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Shingler(words)
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                tokens = [own.hashes(t).tobytes() for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.binary())], ["class_id", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.join(wanted.select(F.col("class_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    return chosen.select("doc_id", "text").mapInArrow(run, f"class_id {kind}, tokens binary")


def _verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The pairs (columns ``a`` and ``b``) whose whole sets are similar enough.

    The sets of ``b`` travel to those of ``a``. Where very many pairs share one ``a``,
    Spark's skew join splits them.
    """
    kind = pairs.schema["a"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (one, two))
                keep.append(_similar(x, y, percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(tokens.toDF("b", "two"), "b").join(tokens.toDF("a", "one"), "a")
    return both.select("a", "b", "two", "one").mapInArrow(check, f"a {kind}, b {kind}")


def similar_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    A document's set holds its distinct shingles of ``words`` words (a shorter text is
    one shingle). Documents link when 100 * |intersection| >= percent * |union|; the
    component id is the smallest key reachable by links, the document itself included.
    A null text, or one without words, has an empty set and links with nothing.
    Repeated rows are kept, each with the same result; rows that share a key but not a
    text are one document to the links. A row with a null key keeps a null component.
    Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    sets = stored(shingle_sets(docs, words, percent), "shingle-sets")
    filled = sets.where("set_key is not null and doc_id is not null")
    classes = stored(filled.groupBy("set_key").agg(F.min("doc_id").alias("class_id")), "shingle-classes")
    links = _links(docs, filled, classes, words, percent)
    roots = components(links.select("a", "b").unionByName(_same_key(filled, classes)))
    known = classes.join(roots.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "set_key", F.coalesce("root", "class_id").alias("root")
    )
    # rows without a set are kept apart, so that no join key is null; the many rows of
    # one set are left to Spark's skew join
    placed = sets.where("set_key is not null").join(known, "set_key", "left").select("doc_id", "n", "root")
    empty = sets.where("set_key is null").select("doc_id", "n", F.col("doc_id").alias("root"))
    return placed.unionByName(empty).select(
        F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("root")).alias("component_id")
    )


def first_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose key is the smallest of its component.

    Of several rows with that key the first by text stays. Rows without a key all stay.
    """
    classes = similar_classes(docs, words, percent, key, text)
    stay = classes.where(F.col(key) == F.col("component_id")).select(key).distinct()
    placed = docs.join(stay, key, "left_semi")
    numbered = placed.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(text, *[c for c in docs.columns if c not in (key, text)])))
    return numbered.where("__n = 1").select(*docs.columns).unionByName(docs.where(F.col(key).isNull()))


def _same_key(filled: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of rows that share a key but not a set: they are one document."""
    several = filled.groupBy("doc_id").agg(F.min("set_key").alias("one"), F.max("set_key").alias("other")).where("one <> other")
    rows = filled.select("doc_id", "set_key").join(several.select("doc_id"), "doc_id", "left_semi").join(classes, "set_key")
    return rows.select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))


def _with_roots(shared: DataFrame, roots: DataFrame) -> DataFrame:
    shared = shared.drop("band")
    return shared.join(roots.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        *shared.columns, F.coalesce("root", "class_id").alias("root")
    )


def _links(docs: DataFrame, filled: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Verified links between classes (``a``, ``b``), and the ``round`` that found each."""
    signed = filled.join(classes.withColumnRenamed("class_id", "doc_id"), ["doc_id", "set_key"], "left_semi")
    signed = stored(signed.select(F.col("doc_id").alias("class_id"), "n", "excess", "bits", "buckets"), "signatures")
    known = signed.select("class_id", "n", "excess", "bits")
    members = signed.select("class_id", F.posexplode("buckets").alias("band", "bucket"))
    # Written out, so that both sides of the join on buckets are shuffled for it alone:
    # then Spark splits the rows of a bucket with very many members over tasks.
    sizes = stored(members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "bucket-sizes")
    shared = stored(members.join(sizes, "bucket"), "buckets")
    tokens = stored(_token_sets(docs, shared.select("class_id"), words), "tokens")

    # a class with its nearest smaller one in a few of its buckets
    few = shared.groupBy("class_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("band", "bucket", "size"))), 1, NEAR_BANDS).alias("few"))
    few = few.join(known, "class_id").withColumn("root", F.col("class_id")).select("*", F.inline("few")).drop("few", "band")
    links = stored(_verified(_best(_nearest(deal_within(few, "class_id", NEAR_BLOCK), percent)), tokens, percent), "links")
    told = links.withColumn("round", F.lit(1))

    # one class of every component in a bucket of several
    placed = _mixed_buckets(stored(_with_roots(shared, components(links)), "placed"))
    ones = placed.groupBy("bucket", "root").agg(F.min("class_id").alias("class_id"))
    ones = stored(ones.join(ones.groupBy("bucket").agg(F.count("*").alias("size")), "bucket"), "of-components")
    near = _nearest(deal_within(ones, "class_id", NEAR_BLOCK).join(known, "class_id"), percent)
    more = stored(_verified(_best(near), tokens, percent), "links")
    told = told.unionByName(more.withColumn("round", F.lit(2)))
    links = links.unionByName(more)

    # all of the buckets that still hold several components
    placed = _mixed_buckets(stored(_with_roots(shared, components(links)), "placed"))
    dealt = deal(placed.select("bucket", "class_id", "root", "size"), "class_id", BLOCK).join(known, "class_id")
    dealt = stored(dealt, "dealt")
    marked = stored(_in_question(dealt, percent), "in-question")
    asked = dealt.join(marked, [*PLACE, "side", "class_id"], "left_semi").join(tokens, "class_id")
    return told.unionByName(stored(_linked(asked, percent), "links").withColumn("round", F.lit(3)))


def _best(near: DataFrame) -> DataFrame:
    """The likest of the classes ``a`` that buckets found for ``b``."""
    return stored(near.groupBy("b").agg(F.max_by("a", F.struct("likeness", "a")).alias("a")).select("a", "b"), "nearest")


def _mixed_buckets(placed: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components."""
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lowest"), F.max("root").alias("highest")).where("lowest <> highest")
    return placed.join(stored(mixed.select("bucket"), "mixed-buckets"), "bucket", "left_semi")

"""Near-duplicate embeddings by binary codes with correction factors (operator 5).

A unit vector is turned by random rotations, and the signs of its coordinates are its
code. With each code two correction factors are stored: the code's inner product with
its vector, and the length of the rest of the code relative to it. They make the inner
product of a code with another vector an unbiased estimate of the cosine with a known
spread. The other vector comes rounded to a byte per coordinate, whose error is known
and widens the spread. A pair is dropped whose upper bounds, by either one's code, lie
below the threshold; only the others are computed again in double precision.

Parts of the code are also the buckets in which vectors meet. Their number is chosen
so that a pair at the threshold shares one with a chance of RECALL at least. To the
buckets go codes, rounded coordinates and factors. The first pass over them names the
rows that are in some pair to be computed again; whole vectors go to a second pass for
these rows alone. A pair is looked at in the first bucket that it shares and in no
other. Tasks pass on rows in question, sums per vector and one edge per linked vector,
never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import batched

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from visitlake.llm.blocks import PLACE, deal, gathered
from visitlake.llm.components import components, stored

THRESHOLD = 0.95
#: Chance at least that a pair exactly at the threshold meets in a bucket.
RECALL = 0.999
#: Standard deviations of the estimate below which a pair at the threshold is dropped.
SPREAD = 4.5
#: Vectors a bucket should hold on average.
BUCKET = 64
BLOCK = 1024
#: Pairs looked at in one step of a task.
STEP = 20_000
SEED = 90210
#: What a bucket is told of a vector: its code, rounded coordinates and factors.
CODED = ["code", "whole", "step", "along", "rest", "off"]


def layout(vectors: int, threshold: float) -> tuple[int, int]:
    """Bits of a bucket and number of buckets per vector for so many vectors."""
    bits = max(6, min(30, round(math.log2(max(1, vectors) / BUCKET)) if vectors else 6))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - same))


@lru_cache(maxsize=8)
def rotations(width: int, bits: int) -> np.ndarray:
    """``bits`` directions: rows of random rotations of ``width`` dimensions."""
    rng = np.random.default_rng([SEED, width])
    rows: list[np.ndarray] = []
    while sum(map(len, rows)) < bits:
        turned, upper = np.linalg.qr(rng.standard_normal((width, min(width, bits))))
        rows.append((turned * np.sign(np.diag(upper))).T)
    return np.concatenate(rows)[:bits]


def encode(units: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (True for plus) of unit vectors, and both correction factors of each."""
    turn = rotations(units.shape[1], bits)
    code = units @ turn.T >= 0
    full = (np.where(code, 1.0, -1.0) @ turn) / math.sqrt(bits)  # the code as a vector of the original space
    along = (full * units).sum(axis=1)
    rest = np.sqrt(np.maximum((full * full).sum(axis=1) - along**2, 0))
    return code, along, rest / along


def rounded(unit: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Coordinates of a unit vector as whole numbers of a byte, the size of one, and the length of what rounding took."""
    step = float(np.float32(np.abs(unit).max() / 127))
    whole = np.clip(np.rint(unit / step), -127, 127).astype(np.int8)
    return whole, step, float(np.linalg.norm(unit - whole * step))


@dataclass
class Codes:
    """Codes (True for plus) of some vectors, their factors, and the vectors with rounded coordinates."""

    code: np.ndarray
    along: np.ndarray
    rest: np.ndarray
    near: np.ndarray
    off: np.ndarray

    @classmethod
    def of_rows(cls, rows: list[tuple], bits: int) -> Codes:
        """From rows of ``CODED`` columns."""
        packed, whole, step, along, rest, off = zip(*rows, strict=True)
        code = np.unpackbits(np.frombuffer(b"".join(packed), np.uint8).reshape(len(rows), -1), axis=1, count=bits).astype(bool)
        near = np.frombuffer(b"".join(whole), np.int8).reshape(len(rows), -1) * np.array(step, np.float32)[:, None]
        return cls(code, np.array(along), np.array(rest), near, np.array(off))


def least_estimate(rest: np.ndarray, off: np.ndarray, width: int, threshold: float) -> np.ndarray:
    """The lowest estimate that a pair at the threshold or above should give, by its code's ``rest`` and the other's ``off``."""
    by_code = rest**2 * (1 - threshold**2) / max(1, width - 1)
    by_rounding = (1 + rest**2) * off**2 / width
    return threshold - SPREAD * np.sqrt(by_code + by_rounding)


def _kept_by(one: Codes, two: Codes, threshold: float) -> np.ndarray:
    """Whether the codes of ``one`` leave it open that a pair reaches the threshold, for all pairs."""
    width, bits = one.near.shape[1], one.code.shape[1]
    turned = two.near @ rotations(width, bits).T.astype(np.float32)
    signs = np.where(one.code, np.float32(1), np.float32(-1))
    estimates = (signs @ turned.T) / (math.sqrt(bits) * one.along[:, None])
    return estimates >= least_estimate(one.rest[:, None], two.off[None, :], width, threshold)


def open_pairs(one: Codes, two: Codes | None, threshold: float, bits: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs to be computed again: of ``one`` and ``two``, or within ``one``.

    Pairs that share one of the first ``table`` buckets, of ``bits`` of the code each, are
    left to that.
    """
    within, two = two is None, two or one
    kept = _kept_by(one, two, threshold)
    kept |= kept.T if within else _kept_by(two, one, threshold).T  # either estimate may keep a pair
    i, j = np.nonzero(np.triu(kept, 1) if within else kept)
    new = np.ones(len(i), bool)
    for k in range(0, len(i) if table else 0, STEP):
        part = slice(k, k + STEP)
        same = one.code[i[part], : table * bits] == two.code[j[part], : table * bits]
        new[part] = ~same.reshape(len(same), table, bits).all(axis=2).any(axis=1)
    return i[new], j[new]


def linked(one: np.ndarray, two: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the unit vectors at ``i`` of ``one`` and ``j`` of ``two`` reach the threshold."""
    good = np.zeros(len(i), bool)
    for k in range(0, len(i), STEP):
        part = slice(k, k + STEP)
        good[part] = np.einsum("ij,ij->i", one[i[part]], two[j[part]]) >= threshold
    return good


def local_roots(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position connected with each position."""
    root = np.arange(size)
    while len(i):
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _prepared(vectors: DataFrame, key: str, embedding: str) -> DataFrame:
    """``vec_id``, ``digest`` of the vector (null if it links with nothing) and its unit vector in double precision."""
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, units = [], []
            for told in batch.column(1):
                unit = None
                if told.is_valid and len(told.values) and not told.values.null_count:
                    v = told.values.to_numpy(zero_copy_only=False) + 0.0
                    most = np.abs(v).max()
                    if np.isfinite(v).all() and most > 0:
                        v = v / most  # no overflow of squares
                        unit = v / math.sqrt(float(v @ v))
                digests.append(None if unit is None else xxhash.xxh3_128_digest((told.values.to_numpy(zero_copy_only=False) + 0.0).tobytes()))
                units.append(None if unit is None else unit.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(units, pa.binary())], ["vec_id", "digest", "unit"]
            )

    return rows.mapInArrow(run, f"vec_id {kind}, digest binary, unit binary")


def _coded(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """Classes with the columns ``CODED`` and a bucket per table."""
    kind = classes.schema["class_id"].dataType.simpleString()
    factors = ["step", "along", "rest", "off"]
    schema = f"digest binary, class_id {kind}, copies bigint, unit binary, code binary, whole binary, "
    schema += "".join(f"{f} float, " for f in factors) + "buckets array<bigint>"
    powers = 1 << np.arange(bits, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, wholes, buckets, told = [], [], [], []
            for unit in batch.column(3).to_pylist():
                v = np.frombuffer(unit, np.float64)
                code, along, rest = encode(v[None, :], bits * tables)
                whole, step, off = rounded(v)
                parts = code[0].reshape(tables, bits) @ powers
                # vectors of another length meet elsewhere
                mixed = (parts.astype(np.uint64) + (np.uint64(len(v)) << np.uint64(40))) * np.uint64(0x9E3779B97F4A7C15)
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.arange(tables, dtype=np.uint64)
                codes.append(np.packbits(code[0]).tobytes())
                wholes.append(whole.tobytes())
                told.append((step, along[0], rest[0], off))
                buckets.append((mixed ^ (mixed >> np.uint64(32))).view(np.int64))
            ends = pa.array(np.arange(len(buckets) + 1, dtype=np.int32) * tables)
            flat = pa.array(np.concatenate(buckets) if buckets else np.zeros(0, np.int64))
            by_factor = np.array(told, np.float32).reshape(-1, len(factors)).T
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes, pa.binary()), pa.array(wholes, pa.binary()), *map(pa.array, by_factor), pa.ListArray.from_arrays(ends, flat)],
                ["digest", "class_id", "copies", "unit", "code", "whole", *factors, "buckets"],
            )

    return classes.select("digest", "class_id", "copies", "unit").mapInArrow(run, schema)


def _sides(rows: list[tuple]) -> tuple[list[tuple], int]:
    """Rows of a block pair, those of the low block first, and their number; 0 where no two rows meet."""
    if rows[0][1] == rows[0][2]:
        return rows, len(rows) if len(rows) > 1 else 0
    rows = sorted(rows, key=lambda r: r[3])
    first = sum(r[3] == 0 for r in rows)
    return rows, first if first < len(rows) else 0


def _batches(found: Iterator[tuple], kinds: list[pa.DataType], names: list[str]) -> Iterator[pa.RecordBatch]:
    for part in batched(found, 5000):
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*part, strict=True), kinds, strict=True)], names)


def _rows_in_question(dealt: DataFrame, bits: int, tables: int, threshold: float) -> DataFrame:
    """Rows of ``dealt`` that are in some pair to be computed again; decided by codes and factors."""

    def rows_in_question(rows: list[tuple]) -> Iterator[tuple]:
        rows, first = _sides(rows)
        if not first:
            return
        one = Codes.of_rows([r[6:] for r in rows[:first]], bits * tables)
        two = Codes.of_rows([r[6:] for r in rows[first:]], bits * tables) if first < len(rows) else None
        i, j = open_pairs(one, two, threshold, bits, rows[0][4])
        for k in np.unique(np.r_[i, j if two is None else j + first]):
            yield rows[k][:6]

    names = [*PLACE, "side", "table", "digest"]
    kinds = [pa.int64(), *[pa.int32()] * 4, pa.binary()]

    def work(groups: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
        return _batches((row for rows in groups for row in rows_in_question(rows)), kinds, names)

    schema = "bucket bigint, low int, high int, side int, table int, digest binary"
    return gathered(dealt, ["table", "digest", *CODED], work, schema)


def _partial_links(dealt: DataFrame, bits: int, tables: int, threshold: float) -> DataFrame:
    """Per block pair and vector with links: rows linked in it, and the smallest id connected."""
    kind = dealt.schema["class_id"].dataType
    id_type = to_arrow_type(kind)

    def units(rows: list[tuple]) -> np.ndarray:
        return np.frombuffer(b"".join(r[8] for r in rows), np.float64).reshape(len(rows), -1)

    def links(rows: list[tuple]) -> Iterator[tuple]:
        rows, first = _sides(rows)
        if not first:
            return
        within = first == len(rows)
        one = Codes.of_rows([r[9:] for r in rows[:first]], bits * tables)
        two = None if within else Codes.of_rows([r[9:] for r in rows[first:]], bits * tables)
        i, j = open_pairs(one, two, threshold, bits, rows[0][4])
        j = j if within else j + first
        exact = units(rows)
        good = linked(exact, exact, i, j, threshold)
        i, j = i[good], j[good]
        if not len(i):
            return
        count = np.zeros(len(rows), np.int64)
        weights = np.array([r[7] for r in rows])
        np.add.at(count, i, weights[j])
        np.add.at(count, j, weights[i])
        ids = [r[6] for r in rows]
        order = np.argsort(np.array(ids), kind="stable")
        place = np.empty(len(rows), np.int64)
        place[order] = np.arange(len(rows))
        root = local_roots(len(rows), place[i], place[j])
        for k in np.unique(np.r_[i, j]):
            yield ids[k], rows[k][5], int(count[k]), ids[order[root[place[k]]]]

    def work(groups: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
        found = (row for rows in groups for row in links(rows))
        return _batches(found, [id_type, pa.binary(), pa.int64(), id_type], ["vec_id", "digest", "links", "toward"])

    columns = ["table", "digest", "class_id", "copies", "unit", *CODED]
    return gathered(dealt, columns, work, f"vec_id {kind.simpleString()}, digest binary, links bigint, toward {kind.simpleString()}")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Rows link when the cosine of their vectors, in double precision, is ``threshold``
    or more. Vectors of different lengths link with nothing of the other, and null,
    empty or zero vectors and those with null or non-finite components with nothing
    at all. Equal vectors are compared once and linked with each other. Repeated rows
    are vectors of their own to ``n_links``; rows that share an id are one vector to
    the components. A null id keeps a null component and is kept. Other columns are not
    read. An empty table gives no rows.
    """
    rows = stored(_prepared(vectors, key, embedding), "vectors")
    usable = rows.where("digest is not null")
    # equal vectors are one class, of which any one's unit vector will do
    classes = usable.groupBy("digest").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"), F.first("unit").alias("unit"))
    classes = stored(classes, "vector-classes")
    bits, tables = layout(classes.count(), threshold)
    coded = stored(_coded(classes.where("class_id is not null"), bits, tables), "codes")
    # all but few buckets are one block: their sizes are not needed
    large = coded.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK)
    met = coded.select("digest", *CODED, F.posexplode("buckets").alias("table", "bucket"))
    met = met.join(stored(large, "large-buckets"), "bucket", "left").fillna(1, ["size"])
    asked = stored(_rows_in_question(deal(met, "digest", BLOCK), bits, tables, threshold), "vectors-in-question")
    found = stored(_partial_links(asked.join(coded.drop("buckets"), "digest"), bits, tables, threshold), "vector-links")
    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    several = usable.groupBy("vec_id").agg(F.min("digest").alias("one"), F.max("digest").alias("other")).where("one <> other")
    same = usable.join(several.select("vec_id"), "vec_id", "left_semi").join(classes.drop("unit"), "digest").select("vec_id", F.col("class_id").alias("toward"))
    roots = components(found.select("vec_id", "toward").unionByName(same))
    told = classes.drop("unit").join(links, "digest", "left").join(roots.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "class_id").alias("component_id")
    )
    with_links = usable.join(told, "digest").select("vec_id", "n_links", "component_id")
    alone = rows.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = with_links.unionByName(alone).withColumn("component_id", F.when(F.col("vec_id").isNotNull(), F.col("component_id")))
    return out.select(F.col("vec_id").alias(key), "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))

"""Document fingerprints that feel the order of a text: order MinHash (operator 4).

Words in runs of K are a text's k-mers, each numbered by how often it occurred before,
so that repeats count. Each of the fingerprint's hash functions selects the PICKED
smallest of all numbered k-mers, puts them back into the order of the text and hashes
that tuple. Two texts agree in a place of the fingerprint if they share the selected
k-mers in the same order, so that the share of equal places falls with the edit distance.

The value of a numbered k-mer under a function is a pair: the rank this function gives
to the k-mer's bucket (one of BUCKETS, by the one stored hash), then a hash of its own.
So the least values lie in the first occupied buckets of a function's order, and only
their members need be hashed; no other k-mer can be less. As buckets are dealt by a
hash, every k-mer of a text is equally likely to be the least of a function.

Everything is expressions over one row: no shuffle, no Python.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 2
PLACES = 32
PICKED = 2
#: Buckets of numbered k-mers, the same for all texts; a power of two.
BUCKETS = 64
#: Bits of a k-mer's hash kept beside its position while k-mers are numbered.
HASH_BITS = 37
POSITION_BITS = 63 - HASH_BITS
#: Groups of neighbouring ids whose texts are put next to each other, 64 times 64 at most.
SPLITS = 64
#: The rank that each function gives to each bucket.
RANKS = [sorted(range(BUCKETS), key=lambda b, n=n: hashlib.sha256(f"{n} {b}".encode()).digest()) for n in range(1, PLACES + 1)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def kmers(text: Column) -> Column:
    """Hashes of the runs of K words; a shorter text is one run, one without words has none."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")

    def runs(w: Column) -> Column:
        last = F.greatest(F.size(w) - K, F.lit(0))
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1)) if K == 2 else F.xxhash64(F.slice(w, i + 1, K)))
        )

    return let(words, runs)


def packed(value: Column, position: Column) -> Column:
    """HASH_BITS of a hash before the position, so that plain numbers sort as pairs."""
    return F.shiftrightunsigned(value, 64 - HASH_BITS) * F.lit(1 << POSITION_BITS).cast("long") + position


def numbered(hashes: Column) -> Column:
    """Packed hash and position of all k-mers, the hash being that of k-mer and occurrence.

    Sorted by hash and position, equal k-mers lie together; the distance to the first
    of them is the occurrence.
    """
    top = F.lit(1 << POSITION_BITS).cast("long")
    kmer = lambda x: F.shiftright(x, POSITION_BITS)

    def by_start(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (kmer(F.get(s, i)) != kmer(F.get(s, i - 1))))
        return let(
            starts,
            lambda b: F.flatten(F.transform(b, lambda start, k: F.transform(
                F.sequence(start, F.coalesce(F.get(b, k + 1), F.size(s)) - 1),
                lambda i: packed(F.xxhash64(kmer(F.get(s, i)), i - start), F.get(s, i) % top),
            ))),
        )

    return let(F.sort_array(F.transform(hashes, packed)), by_start)


def signature(text: Column) -> Column:
    """Array of PLACES hashes; an empty array for a text without words."""
    top = F.lit(1 << POSITION_BITS).cast("long")
    kmer = lambda x: F.shiftright(x, POSITION_BITS)
    bucket_bits = BUCKETS.bit_length() - 1
    bucket = lambda x: F.shiftright(x, 63 - bucket_bits).cast("int")
    table = F.array(*[F.array(*map(F.lit, ranks)) for ranks in RANKS])

    def ordered_hash(picked: Column, n: Column) -> Column:
        """Hash of the chosen k-mers, in the order of the text."""
        return F.xxhash64(F.transform(F.sort_array(F.transform(picked, lambda p: F.struct((p % top).alias("at"), kmer(p).alias("h")))), lambda p: p["h"]), n)

    def least(values: Column) -> Column:
        """The PICKED least of different values, or all if there are fewer."""

        def after(known: Column, more: int) -> Column:
            if more == 0:
                return F.array(known)
            return F.concat(F.array(known), let(F.array_min(F.filter(values, lambda v: v > known)), lambda v: after(v, more - 1)))

        return F.filter(let(F.array_min(values), lambda v: after(v, PICKED - 1)), lambda v: v.isNotNull())

    def place(s: Column, starts: Column, occupied: Column, ranks: Column, n: Column) -> Column:
        """``s`` holds all numbered k-mers in order, ``starts`` where its ``occupied`` buckets begin, ``ranks`` those of function ``n``."""
        members = lambda k: F.slice(s, F.get(starts, k) + 1, F.coalesce(F.get(starts, k + 1), F.size(s)) - F.get(starts, k))

        def first_buckets(ranked: Column) -> Column:
            """Members of the first occupied bucket; of PICKED buckets if it holds too few."""
            part = lambda r: members(r % BUCKETS)
            return let(part(F.array_min(ranked)), lambda one: F.when(F.size(one) >= PICKED, one).otherwise(F.flatten(F.transform(least(ranked), part))))

        def chosen(few: Column) -> Column:
            value = lambda p, i: (
                F.get(ranks, bucket(p)) * F.lit(1 << (63 - bucket_bits)).cast("long")
                + F.shiftrightunsigned(F.xxhash64(kmer(p), n), 64 - HASH_BITS + bucket_bits) * top + i
            )
            return let(F.transform(few, value), lambda values: F.transform(least(values), lambda v: F.get(few, (v % top).cast("int"))))

        ranked = F.transform(occupied, lambda b, k: F.get(ranks, b) * BUCKETS + k)
        return ordered_hash(let(let(ranked, first_buckets), chosen), n)

    def placed(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (bucket(F.get(s, i)) != bucket(F.get(s, i - 1))))
        return let(starts, lambda a: let(F.transform(a, lambda i: bucket(F.get(s, i))), lambda o: F.transform(table, lambda ranks, k: place(s, a, o, ranks, k + 1))))

    def places(hashes: Column) -> Column:
        return F.when(F.size(hashes) == 0, F.array().cast("array<bigint>")).otherwise(let(F.sort_array(numbered(hashes)), placed))

    return let(kmers(text), places)


def shown(places: Column) -> Column:
    """A fingerprint as text: its places in hexadecimal, or a minus for a text without words."""
    return F.when(F.size(places) == 0, "-").otherwise(F.array_join(F.transform(places, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), ""))


def likeness(one: Column, two: Column) -> Column:
    """Share of equal places; texts without words are alike with each other only."""
    same = F.aggregate(F.zip_with(one, two, lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))
    empty = (F.size(one) == 0) | (F.size(two) == 0)
    return F.when(empty, (F.size(one) == F.size(two)).cast("double")).otherwise(same / F.lit(float(PLACES)))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``places`` (the fingerprint) of every row; a null text counts as empty."""
    return docs.select(F.col(key), signature(F.coalesce(F.col(text), F.lit(""))).alias("places"))


def with_next(rows: DataFrame, key: str, take: list[str], tie: str) -> DataFrame:
    """``rows`` with the ``take`` columns of the next row (named ``next_...``): descending ``key``, the first after the last.

    Rows of one key follow each other by ``tie``; rows without a key follow only each
    other. Ids are split into groups of neighbours at their quantiles, so that each row
    moves once; the first row of a group is also sent to the group whose last row it
    follows. What the driver reads is a few numbers per group, SPLITS * SPLITS at most.
    """
    ids = rows.select(F.col(key).cast("long").alias("id"))
    share = [k / SPLITS**2 for k in range(1, SPLITS**2)]
    bounds = sorted(set(ids.agg(F.percentile_approx("id", F.array(*map(F.lit, share)), F.lit(20_000))).first()[0] or []))
    fine = [bounds[k : k + SPLITS] for k in range(0, len(bounds), SPLITS)]
    number = lambda values: F.array(*map(F.lit, values)).cast("array<bigint>")
    held = F.col(key).cast("long")
    below = lambda values: F.size(F.filter(values, lambda b: b <= held))
    coarse = below(number([part[0] for part in fine]))
    table = F.array(*map(number, [[], *fine]))
    group = F.when(held.isNull(), -1).otherwise(let(coarse, lambda c: c * (SPLITS + 1) + below(F.get(table, c))))
    tops = {r["g"]: r["top"] for r in ids.withColumnRenamed("id", key).groupBy(group.alias("g")).agg(F.max(key).alias("top")).collect()}
    order = sorted(g for g in tops if g >= 0)
    above = dict(zip(order, [*order[1:], *order[:1]], strict=True))
    top = F.get(number([tops.get(g) for g in range(max(order, default=-1) + 1)]), F.col("__group"))
    to = F.get(number([above.get(g) for g in range(max(order, default=-1) + 1)]), F.col("__group")).cast("int")
    guest = F.when((F.col("__group") >= 0) & (held == top), to)
    spread = rows.withColumn("__group", group).withColumn("__to", F.explode(F.filter(
        F.array(F.struct(F.col("__group").alias("g"), F.lit(0).alias("guest")), F.struct(guest.alias("g"), F.lit(1).alias("guest"))),
        lambda x: x["g"].isNotNull(),
    )))
    window = Window.partitionBy("__to.g").orderBy(F.col("__to.guest"), F.col(key).desc_nulls_last(), F.col(tie))
    led = spread.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in take])
    return led.where("__to.guest = 0").drop("__to", "__group")


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's fingerprint, and what an edit of half the text makes of it.

    The last floor(n_chars / 2) code points are replaced by the first as many (or all)
    of the next row's text: descending ``key``, the first row after the last. Rows that
    share a key follow each other by their text. A null text counts as empty. A single
    row is its own next. Other columns of ``docs`` are not read. An empty table gives
    no rows.
    """
    own = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = own.withColumn("places", signature(F.col("text")))
    rows = with_next(own, key, ["text", "places"], "text")
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    begun = F.substring(F.col("text"), F.lit(1), F.length("text") - half)
    rows = rows.withColumn("edited", F.concat(begun, F.substring(F.coalesce("next_text", "text"), F.lit(1), half)))
    rows = rows.withColumn("edited_places", signature(F.col("edited")))
    return rows.select(
        key, "n_chars", F.sha2("edited", 256).alias("edited_sha256"), shown(F.col("places")).alias("fingerprint"),
        shown(F.col("edited_places")).alias("edited_fingerprint"), likeness(F.col("places"), F.col("edited_places")).alias("near_edited"),
        likeness(F.col("places"), F.coalesce("next_places", "places")).alias("near_next"),
    )

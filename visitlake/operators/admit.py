"""Admission: which cleaned rows are new, and what becomes of the others.

The first copy of an id wins, in file order. Copies are cut to one per task
before the shuffle (Spark pushes ``row_number() = 1`` below the exchange), so an
id copied very often is never gathered, and the joins behind see unique ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.operators.id_index import IdIndex
from visitlake.schemas import ORIGIN

#: The number of a row among those of a load, and the stretch of numbers that share a bitmap.
NUMBER, STRETCH = "__number", "__stretch"
#: What is stored: the table, or the index of its ids.
Stored = DataFrame | IdIndex


def first_rows(rows: DataFrame, key: list[str]) -> DataFrame:
    """The earliest row of each key."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*ORIGIN))
    return rows.withColumn("copy", place).where(F.col("copy") == 1).drop("copy")


def stored_among(stored: Stored, rows: DataFrame, key: list[str]) -> DataFrame:
    """Stored keys that a load brings again.

    The stored side is reduced by the keys of the load before it is compared with wide
    rows. A load has few keys beside the table, so that Spark may broadcast them by
    their measured size and need not shuffle the table's. An index reads only buckets
    that may hold one of the keys.
    """
    wanted = rows.select(*key).distinct()
    if isinstance(stored, IdIndex):
        return stored.among(wanted)
    return stored.select(*key).join(wanted, key, "left_semi").distinct()


def not_stored(rows: DataFrame, stored: Stored, key: list[str], brought: DataFrame | None = None) -> DataFrame:
    """``rows`` whose key is not stored. ``brought`` holds the keys of the load, if they are cheaper to get than through ``rows``."""
    return rows.join(stored_among(stored, rows if brought is None else brought, key), key, "left_anti")


def admit_caregivers(rows: DataFrame, stored: Stored) -> DataFrame:
    """New caregivers among readable rows."""
    return not_stored(first_rows(rows, ["caregiverId"]), stored, ["caregiverId"], rows)


def unknown_caregivers(rows: DataFrame, caregivers: Stored) -> DataFrame:
    """Caregiver ids that visits name but no caregiver has.

    Ids are made distinct before they are compared, so neither a caregiver with
    very many visits nor a missing id in very many rows makes a large group. The
    result is normally tiny, and removing it costs the visits no shuffle; when it
    is not, the join below is an ordinary one that adaptive execution may split.
    """
    named = rows.select("caregiverId").distinct()
    known = caregivers.among(named) if isinstance(caregivers, IdIndex) else caregivers.select("caregiverId")
    return named.join(known, "caregiverId", "left_anti")


def admit_carelogs(rows: DataFrame, unknown: DataFrame, stored: Stored) -> DataFrame:
    """New visits of known caregivers among readable rows.

    Visits of unknown caregivers are dropped first: a visit whose first copy names
    an unknown caregiver is admitted through its next copy.
    """
    known = rows.join(unknown, "caregiverId", "left_anti")
    return not_stored(first_rows(known, ["carelogId"]), stored, ["carelogId"], rows)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a number for each. It holds once they are written out, as it depends on the tasks."""
    return rows.withColumn(NUMBER, F.monotonically_increasing_id())


def bits(chosen: DataFrame) -> DataFrame:
    """The numbers of ``chosen`` as bitmaps, a row of 4 KB for each stretch of 32,768 numbers."""
    number = F.col(NUMBER)
    return chosen.groupBy(F.bitmap_bucket_number(number).alias(STRETCH)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))


def marked(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The numbered ``rows`` whose bit is set. They do not move: the bitmaps, a bit for a row, go to them."""
    place = F.bitmap_bit_position(F.col(NUMBER))
    byte = F.substring(F.col("bitmap"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1
    here = rows.withColumn(STRETCH, F.bitmap_bucket_number(F.col(NUMBER)))
    return here.join(F.broadcast(bitmaps), STRETCH).where(is_set).drop(STRETCH, "bitmap")


def orphans(rows: DataFrame, unknown: DataFrame) -> DataFrame:
    """Readable visits of unknown caregivers."""
    return rows.join(unknown, "caregiverId", "left_semi")


def duplicates(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Per id: how many readable rows are not admitted as copies, and whether the id was stored before."""
    copies = rows.groupBy(key).agg(F.count("*").alias("copies"))
    flagged = copies.join(stored.select(key, F.lit(True).alias("stored")), key, "left")
    already: Column = F.coalesce("stored", F.lit(False))
    skipped = F.when(already, F.col("copies")).otherwise(F.col("copies") - 1)
    return flagged.select(key, already.alias("already_stored"), skipped.alias("skipped_rows")).where(skipped > 0)

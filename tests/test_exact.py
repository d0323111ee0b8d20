"""Rounding against decimal arithmetic."""

import random
from decimal import ROUND_HALF_UP, Decimal, getcontext

from pyspark.sql import functions as F

from visitlake.functions import exact

getcontext().prec = 60


def rounded(p, q, places="0.01"):
    return (Decimal(p) / Decimal(q)).quantize(Decimal(places), ROUND_HALF_UP)


def test_hundredths(spark):
    random.seed(7)
    pairs = [(57, 20000), (1, 200), (-1, 200), (1005, 1000), (0, 5), (10**17, 3), (-(10**17), 7)]
    pairs += [(random.randint(-10**12, 10**12), random.randint(1, 10**9)) for _ in range(300)]
    pairs += [(5 * random.randint(-999, 999), 1000) for _ in range(100)]
    frame = spark.createDataFrame(pairs, "p bigint, q bigint")
    for row in frame.select("p", "q", exact.hundredths(F.col("p"), F.col("q")).alias("h")).collect():
        assert Decimal(row.h) / 100 == rounded(row.p, row.q), (row.p, row.q)


def test_unknown_ratio(spark):
    frame = spark.createDataFrame([(1, 0), (None, 1), (1, None)], "p bigint, q bigint")
    assert [r[0] for r in frame.select(exact.hundredths(F.col("p"), F.col("q"))).collect()] == [None] * 3


def test_texts(spark):
    frame = spark.createDataFrame([(3330,), (5000,), (5,), (250,), (1249,)], "h bigint")
    h = F.col("h")
    shown = [tuple(r) for r in frame.select(exact.text2(h), exact.text1(h), exact.text0(h)).collect()]
    assert shown == [("33.30", "33.3", "33"), ("50.00", "50.0", "50"), ("0.05", "0.1", "0"), ("2.50", "2.5", "3"), ("12.49", "12.5", "12")]


def test_round_double_is_up_at_ties(spark):
    frame = spark.createDataFrame([(1.005,), (0.285,), (2.5,), (0.0,)], "x double")
    assert [r[0] for r in frame.select(exact.round_double(F.col("x"))).collect()] == [1.01, 0.29, 2.5, 0.0]

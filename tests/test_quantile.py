"""Exact quantiles against numpy."""

import random
from fractions import Fraction

import numpy as np
import pytest

from visitlake.operators.quantile import exact_quantiles

PROBABILITIES = {"q1": Fraction(1, 4), "median": Fraction(1, 2), "q3": Fraction(3, 4)}


def groups():
    random.seed(3)
    return {
        "one": [42],
        "two": [10, 11],
        "equal": [500] * 30,
        "wide": [random.randint(0, 10**6) for _ in range(501)],
        "negative": [random.randint(-3000, 3000) for _ in range(200)],
        # one group holds most rows, nearly all of one value
        "hot": [777] * 3000 + [random.randint(0, 2000) for _ in range(2000)],
    }


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("width", [1, 100, 10**9])
def test_per_group(spark, small, width):
    data = groups()
    frame = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs] + [("one", None)], "k string, v bigint")
    found = exact_quantiles(frame, ["k"], "v", PROBABILITIES, width, small).collect()
    assert {r.k for r in found} == set(data)
    for row in found:
        for name, p in PROBABILITIES.items():
            assert row[name] == pytest.approx(np.quantile(data[row.k], float(p)), abs=1e-9), (row.k, name)
            assert row[f"{name}_low"] <= row[name] <= row[f"{name}_high"]


def test_global_and_empty(spark):
    frame = spark.createDataFrame([(v,) for v in range(11)], "v bigint")
    row = exact_quantiles(frame, [], "v", PROBABILITIES, 3, small=True).first()
    assert (row.q1, row.median, row.q3) == (2.5, 5.0, 7.5)
    empty = exact_quantiles(frame.where("v > 99"), [], "v", PROBABILITIES, 3, small=True).collect()
    assert [r.median for r in empty] == [None]

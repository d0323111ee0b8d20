"""The index of stored ids: same answers as the table, and only the buckets needed are read."""

import re

import pytest

from visitlake.operators.admit import stored_among
from visitlake.operators.id_index import IdIndex
from visitlake.session import fresh_path
from visitlake.sources.tables import append, read_table


def ids(spark, numbers):
    return spark.createDataFrame([(f"K{n}",) for n in numbers], "caregiverId string")


@pytest.fixture
def warehouse(spark):
    return fresh_path(spark, "index-test")


def found(index, frame):
    return sorted(r[0] for r in index.among(frame).collect())


def test_an_absent_table_has_no_ids(spark, warehouse):
    index = IdIndex(spark, warehouse, "caregiver", "caregiverId").sync()
    assert found(index, ids(spark, range(5))) == []


def test_answers_are_those_of_the_table_after_every_load(spark, warehouse):
    stored = set()
    for low, high in [(0, 300), (300, 320), (250, 400), (400, 3000)]:
        append(ids(spark, range(low, high)).union(spark.createDataFrame([(None,)], "caregiverId string")), warehouse, "caregiver")
        stored |= set(range(low, high))
        index = IdIndex(spark, warehouse, "caregiver", "caregiverId", ids_per_bucket=100).sync()
        asked = [*range(0, 5000, 3), 1, 1]
        assert found(index, ids(spark, asked)) == sorted({f"K{n}" for n in asked} & {f"K{n}" for n in stored})
        table = read_table(spark, warehouse, "caregiver")
        assert found(index, ids(spark, asked)) == sorted(r[0] for r in stored_among(table, ids(spark, asked), ["caregiverId"]).collect())
    assert index.generation > 0 and index.buckets > 20  # it was dealt anew while it grew
    again = IdIndex(spark, warehouse, "caregiver", "caregiverId", ids_per_bucket=100)
    assert (again.generation, again.buckets, again.size) == (index.generation, index.buckets, index.size)


def test_few_unknown_ids_pass_the_filter(spark, warehouse):
    append(ids(spark, range(20_000)), warehouse, "caregiver")
    index = IdIndex(spark, warehouse, "caregiver", "caregiverId", ids_per_bucket=2_000).sync()
    assert index.possible(ids(spark, range(20_000))).count() >= 20_000
    assert index.possible(ids(spark, range(20_000, 40_000))).count() < 200


def test_only_buckets_that_may_hold_an_id_are_read(spark, warehouse):
    append(ids(spark, range(20_000)), warehouse, "caregiver")
    index = IdIndex(spark, warehouse, "caregiver", "caregiverId", ids_per_bucket=1_000).sync()
    assert index.buckets == 40
    result = index.among(ids(spark, [5, 77, 90_001]))
    plan = result._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    numbers = {r.bucket for r in index.place(ids(spark, [5, 77])).collect()}
    assert all(re.search(rf"\b{n}\b", filters) for n in numbers) and "bucket" in filters
    read = index.bucket_rows(sorted(numbers)).inputFiles()
    assert read and len(index.bucket_rows(list(range(40))).inputFiles()) > len(numbers)
    rows = result.collect()
    assert sorted(r[0] for r in rows) == ["K5", "K77"]
    # an unknown id opens no bucket at all
    assert "id_index" not in index.among(ids(spark, [90_001]))._jdf.queryExecution().executedPlan().toString()


def test_rows_between_table_and_index_are_found(spark, warehouse):
    """A load that ended after the table was written and before the index was."""
    append(ids(spark, range(50)), warehouse, "caregiver")
    IdIndex(spark, warehouse, "caregiver", "caregiverId").sync()
    append(ids(spark, range(50, 60)), warehouse, "caregiver")
    late = IdIndex(spark, warehouse, "caregiver", "caregiverId")
    assert found(late, ids(spark, [55])) == []
    assert found(late.sync(), ids(spark, [55])) == ["K55"]
    assert late.size == 60 and late.covered and late.sync().size == 60

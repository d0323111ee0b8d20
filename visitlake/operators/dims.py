"""Dimension tables found in the caregiver rows: franchisors, agencies, locations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.functions.parsing import text
from visitlake.operators.admit import first_rows, not_stored
from visitlake.schemas import ORIGIN


def _extract(raw: DataFrame, fields: dict[str, str], key: list[str], filled: list[str]) -> DataFrame:
    """First row per key among rows whose ``filled`` columns are not empty."""
    columns = raw.select(*[text(F.col(field)).alias(name) for name, field in fields.items()], *ORIGIN)
    for name in filled:
        columns = columns.where(F.col(name) != "")
    return first_rows(columns, key).select(*fields)


def franchisors(raw: DataFrame, stored: DataFrame) -> DataFrame:
    found = _extract(
        raw, {"franchisorId": "franchisor_id", "name": "franchisor_name"}, ["franchisorId"], ["franchisorId"]
    )
    return not_stored(found, stored, ["franchisorId"])


def agencies(raw: DataFrame, stored: DataFrame) -> DataFrame:
    key = ["agencyId", "franchisorId"]
    fields = {
        "agencyId": "agency_id", "franchisorId": "franchisor_id", "name": "agency_name", "subdomain": "subdomain",
    }
    return not_stored(_extract(raw, fields, key, key), stored, key)


def locations(raw: DataFrame, stored: DataFrame) -> DataFrame:
    fields = {"locationId": "locations_id", "locationName": "location_name"}
    return not_stored(_extract(raw, fields, ["locationId"], list(fields)), stored, ["locationId"])

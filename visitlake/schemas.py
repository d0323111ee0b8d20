"""Table and file layouts."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _FLAG, _INT, _TIME = T.StringType(), T.BooleanType(), T.IntegerType(), T.TimestampNTZType()


def _table(*columns: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in columns])


# Table layouts, (column, type, nullable) in natural order.
FRANCHISOR = _table(("franchisorId", _TEXT, False), ("name", _TEXT, True))
AGENCY = _table(
    ("agencyId", _TEXT, False), ("franchisorId", _TEXT, False), ("name", _TEXT, True), ("subdomain", _TEXT, True)
)
LOCATION = _table(("locationId", _TEXT, False), ("locationName", _TEXT, False))
CAREGIVER = _table(
    ("caregiverId", _TEXT, False), ("externalId", _TEXT, True), ("profileId", _TEXT, False),
    ("franchisorId", _TEXT, False), ("agencyId", _TEXT, False), ("locationId", _TEXT, True),
    ("firstName", _TEXT, False), ("lastName", _TEXT, False), ("email", _TEXT, True),
    ("phoneNumber", _TEXT, True), ("gender", _TEXT, True), ("applicant", _FLAG, False),
    ("birthdayDate", _TIME, True), ("onboardingDate", _TIME, True),
    ("applicantStatus", _TEXT, False), ("status", _TEXT, False),
)
CARELOG = _table(
    ("carelogId", _TEXT, False), ("caregiverId", _TEXT, False), ("franchisorId", _TEXT, False),
    ("agencyId", _TEXT, False), ("parentId", _TEXT, True), ("startDatetime", _TIME, True),
    ("endDatetime", _TIME, True), ("clockInActualDatetime", _TIME, True),
    ("clockOutActualDatetime", _TIME, True), ("clockInMethod", _TEXT, True), ("clockOutMethod", _TEXT, True),
    ("status", _TEXT, False), ("split", _FLAG, False), ("documentation", _TEXT, True),
    ("generalCommentCharCount", _INT, True),
)
TABLES = {
    "franchisor": FRANCHISOR, "agency": AGENCY, "location": LOCATION, "caregiver": CAREGIVER, "carelog": CARELOG,
}

# Keys that must be unique, and references (child columns -> parent columns).
UNIQUE_KEYS = [
    ("franchisor", ("franchisorId",)),
    ("agency", ("agencyId", "franchisorId")),
    ("location", ("locationId",)),
    ("caregiver", ("caregiverId",)),
    ("caregiver", ("caregiverId", "franchisorId", "agencyId")),
    ("carelog", ("carelogId",)),
]
FOREIGN_KEYS = [
    ("agency", ("franchisorId",), "franchisor"),
    ("caregiver", ("franchisorId",), "franchisor"),
    ("caregiver", ("agencyId", "franchisorId"), "agency"),
    ("caregiver", ("locationId",), "location"),
    ("carelog", ("caregiverId",), "caregiver"),
    ("carelog", ("franchisorId",), "franchisor"),
    ("carelog", ("agencyId", "franchisorId"), "agency"),
]

# Columns of the raw files.
RAW_CAREGIVER = [
    "franchisor_id", "franchisor_name", "agency_id", "agency_name", "subdomain", "profile_id", "caregiver_id",
    "external_id", "first_name", "last_name", "email", "phone_number", "gender", "applicant", "birthday_date",
    "onboarding_date", "locations_id", "location_name", "applicant_status", "status",
]
RAW_CARELOG = [
    "franchisor_id", "agency_id", "carelog_id", "caregiver_id", "parent_id", "start_datetime", "end_datetime",
    "clock_in_actual_datetime", "clock_out_actual_datetime", "clock_in_method", "clock_out_method", "status",
    "split", "documentation", "general_comment_char_count",
]

# Where a raw row came from. Ordering by these takes older files first, files of one
# moment by name, and the rows of a file in their order.
ORIGIN = ["modified", "source_file", "block_start", "row_id"]
CORRUPT = "_corrupt_record"


def raw_schema(fields: list[str]) -> T.StructType:
    """All-text layout of a raw file, plus the column that receives unreadable rows."""
    return T.StructType([T.StructField(f, _TEXT, True) for f in [*fields, CORRUPT]])

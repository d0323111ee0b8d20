"""Row cleaning: one projection per table, compiled from a rule list."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.functions import parsing
from visitlake.functions.ladders import ladder
from visitlake.schemas import CORRUPT, ORIGIN

UNREADABLE = "unreadable_times"


@dataclass(frozen=True)
class Rule:
    """How one raw field becomes one table column."""

    field: str
    column: str
    transform: Callable[[Column], Column] = parsing.text
    required: bool = False
    kind: str = "string"


def _placeholder(c: Column) -> Column:
    return parsing.email(c, F.col("caregiver_id"))


# Raw field, table column, rule, required, type.
CAREGIVER_RULES = [
    Rule("caregiver_id", "caregiverId", required=True),
    Rule("external_id", "externalId"),
    Rule("profile_id", "profileId", required=True),
    Rule("franchisor_id", "franchisorId", required=True),
    Rule("agency_id", "agencyId", required=True),
    Rule("locations_id", "locationId"),
    Rule("first_name", "firstName", required=True),
    Rule("last_name", "lastName", required=True),
    Rule("email", "email", _placeholder),
    Rule("phone_number", "phoneNumber"),
    Rule("gender", "gender"),
    Rule("applicant", "applicant", parsing.flag, required=True, kind="boolean"),
    Rule("birthday_date", "birthdayDate", parsing.timestamp, kind="timestamp_ntz"),
    Rule("onboarding_date", "onboardingDate", parsing.timestamp, kind="timestamp_ntz"),
    Rule("applicant_status", "applicantStatus", required=True),
    Rule("status", "status", required=True),
]
CARELOG_RULES = [
    Rule("carelog_id", "carelogId", required=True),
    Rule("caregiver_id", "caregiverId", required=True),
    Rule("franchisor_id", "franchisorId", required=True),
    Rule("agency_id", "agencyId", required=True),
    Rule("parent_id", "parentId"),
    Rule("start_datetime", "startDatetime", parsing.timestamp, required=True, kind="timestamp_ntz"),
    Rule("end_datetime", "endDatetime", parsing.timestamp, required=True, kind="timestamp_ntz"),
    Rule("clock_in_actual_datetime", "clockInActualDatetime", parsing.timestamp, kind="timestamp_ntz"),
    Rule("clock_out_actual_datetime", "clockOutActualDatetime", parsing.timestamp, kind="timestamp_ntz"),
    Rule("clock_in_method", "clockInMethod"),
    Rule("clock_out_method", "clockOutMethod"),
    Rule("status", "status", required=True),
    Rule("split", "split", parsing.flag, required=True, kind="boolean"),
    Rule("documentation", "documentation"),
    Rule("general_comment_char_count", "generalCommentCharCount", parsing.whole_number, kind="int"),
]


class MissingColumns(ValueError):
    """The input lacks required columns; raised before any job starts."""


def apply_rules(raw: DataFrame, rules: list[Rule]) -> DataFrame:
    """Clean and rename in one projection.

    A field the input does not have stays NULL, unless it is required. The
    columns telling where a row came from are kept, and ``unreadable_times`` tells how
    many of a row's times are neither empty nor readable.
    """
    present = set(raw.columns)
    missing = [rule.field for rule in rules if rule.required and rule.field not in present]
    if missing:
        raise MissingColumns(f"required columns not found: {', '.join(missing)}")
    cleaned = [
        (rule.transform(F.col(rule.field)) if rule.field in present else F.lit(None).cast(rule.kind)).alias(rule.column)
        for rule in rules
    ]
    times = {f"__{rule.field}": rule for rule in rules if rule.transform is parsing.timestamp and rule.field in present}
    told = raw.select(*cleaned, *ORIGIN, CORRUPT, *[F.col(rule.field).alias(name) for name, rule in times.items()])
    unreadable = sum((parsing.unreadable_time(F.col(n), F.col(rule.column)).cast("int") for n, rule in times.items()), F.lit(0))
    return told.withColumn(UNREADABLE, unreadable).drop(*times)


def clean_caregivers(raw: DataFrame) -> DataFrame:
    return apply_rules(raw, CAREGIVER_RULES)


def clean_carelogs(raw: DataFrame) -> DataFrame:
    return apply_rules(raw, CARELOG_RULES)


def reject_reason(key: str) -> Column:
    """Why a row cannot be admitted; NULL if it can."""
    return ladder(
        [(F.col(CORRUPT).isNotNull(), "fewer columns than the header"), (F.col(key) == "", "empty id")], None
    )


def readable(cleaned: DataFrame, key: str) -> DataFrame:
    return cleaned.where(reject_reason(key).isNull()).drop(CORRUPT)


def rejects(cleaned: DataFrame, key: str) -> DataFrame:
    """Rows set aside, with their place and the reason; all others go on."""
    return cleaned.withColumn("reason", reject_reason(key)).where(F.col("reason").isNotNull())

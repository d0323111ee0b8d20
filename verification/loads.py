"""Check statements for cleaning, admission, metrics, file reports and constraints."""

from __future__ import annotations

from verification.base import RAW_CAREGIVER, RAW_CARELOG, WORKERS
from visitlake.sources.derived import (
    LONG_ROW, MISSING_PARENTS, NO_VALUE, SHORT_ROW, STORED_BEFORE, STORED_REGION, STORED_SEGMENT,
)

BOTH_RAW = f"{RAW_CAREGIVER}, {RAW_CARELOG}"


def txt(c: str) -> str:
    return f"coalesce({c}, '')"


FORMATS = [
    "%m/%d/%Y, %I:%M:%S %p", "%m/%d/%Y %I:%M %p", "%b %d %Y %H:%M", "%d %B %Y %H:%M", "%a, %d %b %Y %H:%M:%S GMT",
    "%a %b %d %Y %H:%M:%S", "%m-%d-%Y %H:%M", "%B %d, %Y %H:%M", "%Y/%m/%d %H:%M:%S",
]


def ts(c: str) -> str:
    formats = ", ".join(f"'{f}'" for f in FORMATS)
    return f"CASE WHEN trim({c}) LIKE '____-%' THEN TRY_CAST(trim({c}) AS TIMESTAMP) ELSE try_strptime(trim({c}), [{formats}]) END"


def lost(*columns: str) -> str:
    """How many of the times are neither empty nor readable."""
    return " + ".join(f"CASE WHEN lower(trim({txt(c)})) NOT IN ('', 'none', 'null') AND {ts(c)} IS NULL THEN 1 ELSE 0 END" for c in columns)


def yes(c: str) -> str:
    return f"coalesce(lower({c}) = 'true', FALSE)"


CAREGIVER_CLEAN = f"""SELECT {txt('caregiver_id')} AS caregiverId, {txt('external_id')} AS externalId,
  {txt('profile_id')} AS profileId, {txt('franchisor_id')} AS franchisorId, {txt('agency_id')} AS agencyId,
  {txt('locations_id')} AS locationId, {txt('first_name')} AS firstName, {txt('last_name')} AS lastName,
  CASE WHEN trim({txt('email')}) = '' THEN 'no-email-' || substr(sha256({txt('caregiver_id')}), 1, 16) || '@placeholder.com'
    ELSE email END AS email,
  {txt('phone_number')} AS phoneNumber, {txt('gender')} AS gender, {yes('applicant')} AS applicant,
  {ts('birthday_date')} AS birthdayDate, {ts('onboarding_date')} AS onboardingDate,
  {txt('applicant_status')} AS applicantStatus, {txt('status')} AS status, source_file, row_id FROM raw_caregiver"""
CAREGIVER_LOST = lost("birthday_date", "onboarding_date")
CARELOG_LOST = lost("start_datetime", "end_datetime", "clock_in_actual_datetime", "clock_out_actual_datetime")
CARELOG_CLEAN = f"""SELECT {txt('carelog_id')} AS carelogId, {txt('caregiver_id')} AS caregiverId,
  {txt('franchisor_id')} AS franchisorId, {txt('agency_id')} AS agencyId, {txt('parent_id')} AS parentId,
  {ts('start_datetime')} AS startDatetime, {ts('end_datetime')} AS endDatetime,
  {ts('clock_in_actual_datetime')} AS clockInActualDatetime, {ts('clock_out_actual_datetime')} AS clockOutActualDatetime,
  {txt('clock_in_method')} AS clockInMethod, {txt('clock_out_method')} AS clockOutMethod, {txt('status')} AS status,
  {yes('split')} AS split, {txt('documentation')} AS documentation,
  CAST(CASE general_comment_char_count WHEN '0x10' THEN 16 WHEN ' 7 ' THEN 7 WHEN '1e3' THEN 1000
    ELSE coalesce(TRY_CAST(general_comment_char_count AS INTEGER), 0) END AS INTEGER) AS generalCommentCharCount,
  source_file, row_id FROM raw_carelog"""

STORED_CAREGIVER = f"SELECT 'CG' || CAST(w AS STRING) AS caregiverId FROM ({WORKERS}) WHERE c_mktsegment = '{STORED_SEGMENT}'"
STORED_CARELOG = f"SELECT 'CL' || CAST(o_orderkey AS STRING) AS carelogId FROM orders WHERE o_orderdate < TIMESTAMP '{STORED_BEFORE}'"
_CLEANED = f"cleaned_caregiver AS ({CAREGIVER_CLEAN}), stored_caregiver AS ({STORED_CAREGIVER})"
_FIRST = "row_number() OVER (PARTITION BY {key} ORDER BY source_file, row_id)"
NEW_CAREGIVER = f"""{_CLEANED}, new_caregiver AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, {_FIRST.format(key='caregiverId')} AS place FROM cleaned_caregiver WHERE caregiverId <> '')
  WHERE place = 1 AND caregiverId NOT IN (SELECT caregiverId FROM stored_caregiver))"""
NEW_CARELOG = f"""cleaned_carelog AS ({CARELOG_CLEAN}), stored_carelog AS ({STORED_CARELOG}), known AS (
  SELECT caregiverId FROM stored_caregiver UNION SELECT caregiverId FROM cleaned_caregiver WHERE caregiverId <> ''
), orphan AS (
  SELECT * FROM cleaned_carelog WHERE carelogId <> '' AND caregiverId NOT IN (SELECT caregiverId FROM known)
), new_carelog AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, {_FIRST.format(key='carelogId')} AS place FROM cleaned_carelog
    WHERE carelogId <> '' AND caregiverId IN (SELECT caregiverId FROM known))
  WHERE place = 1 AND carelogId NOT IN (SELECT carelogId FROM stored_carelog))"""
LOAD = f"WITH {BOTH_RAW}, {NEW_CAREGIVER}, {NEW_CARELOG}"

_KNOWN_NATION = f"SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = '{STORED_REGION}'"


def _dim(key: list[str], fields: dict[str, str], filled: list[str], stored: str) -> str:
    """First file row per key, not yet stored."""
    columns = ", ".join(f"{txt(field)} AS {name}" for name, field in fields.items())
    keys = ", ".join(key)
    given = " AND ".join(f"{c} <> ''" for c in filled)
    return (
        f"SELECT {', '.join(fields)} FROM (SELECT *, {_FIRST.format(key=keys)} AS place FROM "
        f"(SELECT {columns}, source_file, row_id FROM raw_caregiver) WHERE {given}) "
        f"WHERE place = 1 AND ({keys}) NOT IN (SELECT {stored} FROM ({_KNOWN_NATION}))"
    )


_F, _A, _L = "'F' || CAST(n_regionkey AS STRING)", "'A' || CAST(n_nationkey AS STRING)", "'L' || CAST(n_nationkey AS STRING)"
FRANCHISOR = _dim(["franchisorId"], {"franchisorId": "franchisor_id", "name": "franchisor_name"}, ["franchisorId"], _F)
AGENCY = _dim(
    ["agencyId", "franchisorId"],
    {"agencyId": "agency_id", "franchisorId": "franchisor_id", "name": "agency_name", "subdomain": "subdomain"},
    ["agencyId", "franchisorId"],
    f"({_A}, {_F})",
)
LOCATION = _dim(
    ["locationId"], {"locationId": "locations_id", "locationName": "location_name"}, ["locationId", "locationName"], _L
)

_PER_FILE = """SELECT source_file, count(*) AS total_rows, count(*) FILTER (WHERE new) AS processed_rows,
    count(*) FILTER (WHERE bad) AS failed_rows, CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS orphan_rows,
    CAST(sum(unreadable) AS BIGINT) AS unreadable_times,
    count(*) FILTER (WHERE NOT new AND NOT bad AND NOT lost) AS duplicate_rows FROM ({rows}) GROUP BY source_file"""
METRICS = (
    _PER_FILE.format(
        rows=f"SELECT r.source_file, n.row_id IS NOT NULL AS new, coalesce(r.caregiver_id, '') = '' AS bad, FALSE AS lost, "
        f"{CAREGIVER_LOST} AS unreadable FROM raw_caregiver r LEFT JOIN new_caregiver n ON n.row_id = r.row_id"
    )
    + " UNION ALL "
    + _PER_FILE.format(
        rows=f"SELECT r.source_file, n.row_id IS NOT NULL AS new, coalesce(r.carelog_id, '') = '' AS bad, o.row_id IS NOT NULL AS lost, "
        f"{CARELOG_LOST} AS unreadable "
        "FROM raw_carelog r LEFT JOIN new_carelog n ON n.row_id = r.row_id LEFT JOIN orphan o ON o.row_id = r.row_id"
    )
)
_SUMS = ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS {c}" for c in
    ["total_rows", "processed_rows", "failed_rows", "orphan_rows", "unreadable_times", "duplicate_rows"]
)
TOTALS = f"""SELECT {_SUMS}, count(*) AS files, 500.0::DOUBLE AS elapsed_ms,
  CAST(sum(processed_rows) AS DOUBLE) / 500 * 1000 AS average_speed,
  CAST(sum(processed_rows) AS DOUBLE) / sum(total_rows) * 100 AS success_rate FROM ({METRICS})"""

CAREGIVER_FIELDS = [
    "franchisor_id", "franchisor_name", "agency_id", "agency_name", "subdomain", "profile_id", "caregiver_id",
    "external_id", "first_name", "last_name", "email", "phone_number", "gender", "applicant", "birthday_date",
    "onboarding_date", "locations_id", "location_name", "applicant_status", "status",
]
CARELOG_FIELDS = [
    "franchisor_id", "agency_id", "carelog_id", "caregiver_id", "parent_id", "start_datetime", "end_datetime",
    "clock_in_actual_datetime", "clock_out_actual_datetime", "clock_in_method", "clock_out_method", "status",
    "split", "documentation", "general_comment_char_count",
]


def _row_length(fields: list[str], short: str | None = None) -> str:
    total = " + ".join(f"length({txt(c)})" for c in fields)
    return total if short is None else f"{total} - CASE WHEN {short} THEN length({txt(fields[-1])}) ELSE 0 END"


def _profile(table: str, fields: list[str], short: str | None = None) -> str:
    length = _row_length(fields, short)
    return (
        f"SELECT source_file, CAST({len(fields)} AS INTEGER) AS column_count, '{','.join(fields)}' AS headers, count(*) AS row_count, "
        f"min({length}) AS shortest_row, max({length}) AS longest_row FROM raw_{table} GROUP BY source_file"
    )


PROFILE = f"""WITH {BOTH_RAW} {_profile('caregiver', CAREGIVER_FIELDS, SHORT_ROW)}
UNION ALL {_profile('carelog', CARELOG_FIELDS)}
UNION ALL SELECT 'extra_empty.csv', 0, '', 0, NULL, NULL UNION ALL SELECT 'extra_twice.csv', 3, 'a,b,a', 1, 2, 2"""
_RAGGED = f"count(*) FILTER (WHERE {SHORT_ROW} OR {LONG_ROW})"
VALIDATE = f"""WITH {BOTH_RAW}
SELECT source_file, '{','.join(CAREGIVER_FIELDS)}' AS headers, '' AS duplicate_columns, count(*) AS row_count,
  {_RAGGED} AS inconsistent_rows, {_RAGGED} = 0 AS is_valid FROM raw_caregiver GROUP BY source_file
UNION ALL SELECT source_file, '{','.join(CARELOG_FIELDS)}', '', count(*), 0, TRUE FROM raw_carelog GROUP BY source_file
UNION ALL SELECT 'extra_empty.csv', '', '', 0, 0, FALSE UNION ALL SELECT 'extra_twice.csv', 'a,b,a', 'a', 1, 0, FALSE"""
BAD_ROWS = f"""WITH {RAW_CAREGIVER}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY row_id) AS row_number FROM raw_caregiver)
SELECT source_file, row_number, CASE WHEN {SHORT_ROW} THEN 'fewer values than columns' ELSE 'more values than columns' END AS problem
FROM placed WHERE {SHORT_ROW} OR {LONG_ROW}"""
PREVIEW = f"""WITH {RAW_CAREGIVER}
SELECT NULLIF(caregiver_id, '') AS caregiver_id, profile_id, NULLIF(franchisor_id, '') AS franchisor_id FROM raw_caregiver
WHERE source_file = 'caregiver_0_0.csv' ORDER BY row_id LIMIT 20"""


def _with_stored(new: str, columns: str, stored: str) -> str:
    return f"SELECT {columns} FROM ({new}) UNION SELECT {stored} FROM ({_KNOWN_NATION})"


def _emptied(cleaned: str, table: str) -> str:
    column, condition = NO_VALUE[table]
    return f"SELECT * REPLACE (CASE WHEN {condition} THEN NULL ELSE {column} END AS {column}) FROM ({cleaned})"


_CHECKED = f"""WITH {BOTH_RAW},
franchisor AS (SELECT * FROM ({_with_stored(FRANCHISOR, 'franchisorId', _F)}) WHERE NOT ({MISSING_PARENTS['franchisor']})),
agency AS (SELECT * FROM ({_with_stored(AGENCY, 'agencyId, franchisorId', f'{_A}, {_F}')}) WHERE NOT ({MISSING_PARENTS['agency']})),
location AS (SELECT * FROM ({_with_stored(LOCATION, 'locationId, locationName', f'{_L}, NULL')}) WHERE NOT ({MISSING_PARENTS['location']})),
worker AS ({_emptied(CAREGIVER_CLEAN, 'caregiver')}), visit AS ({_emptied(CARELOG_CLEAN, 'carelog')})"""
_NAMES = {"caregiver": "worker", "carelog": "visit"}


def _unique(table: str, *key: str) -> str:
    return (
        f"SELECT '{table}({','.join(key)})' AS constraint_name, count(*) AS repeated_keys, "
        f"CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS surplus_rows FROM "
        f"(SELECT count(*) AS c FROM {_NAMES.get(table, table)} GROUP BY {', '.join(key)} HAVING count(*) > 1)"
    )


def _foreign(child: str, key: tuple[str, ...], parent: str) -> str:
    match = " AND ".join(f"p.{c} = x.{c}" for c in key)
    blank = " OR ".join(f"x.{c} = ''" for c in key)
    given = " AND ".join(f"x.{c} IS NOT NULL" for c in key)
    return (
        f"SELECT '{child}({','.join(key)})->{parent}' AS constraint_name, "
        f"count(*) FILTER (WHERE NOT ({blank})) AS violating_rows, count(*) FILTER (WHERE {blank}) AS blank_rows "
        f"FROM {_NAMES.get(child, child)} x "
        f"WHERE {given} AND NOT EXISTS (SELECT 1 FROM {_NAMES.get(parent, parent)} p WHERE {match})"
    )


UNIQUE = [
    _unique("franchisor", "franchisorId"), _unique("agency", "agencyId", "franchisorId"), _unique("location", "locationId"),
    _unique("caregiver", "caregiverId"), _unique("caregiver", "caregiverId", "franchisorId", "agencyId"), _unique("carelog", "carelogId"),
]
FOREIGN = [
    _foreign("agency", ("franchisorId",), "franchisor"), _foreign("caregiver", ("franchisorId",), "franchisor"),
    _foreign("caregiver", ("agencyId", "franchisorId"), "agency"), _foreign("caregiver", ("locationId",), "location"),
    _foreign("carelog", ("caregiverId",), "caregiver"), _foreign("carelog", ("franchisorId",), "franchisor"),
    _foreign("carelog", ("agencyId", "franchisorId"), "agency"),
]
NEEDED = {
    "franchisor": ["franchisorId"], "agency": ["agencyId", "franchisorId"], "location": ["locationId", "locationName"],
    "caregiver": [
        "caregiverId", "profileId", "franchisorId", "agencyId", "firstName", "lastName", "applicant", "applicantStatus", "status",
    ],
    "carelog": ["carelogId", "caregiverId", "franchisorId", "agencyId", "status", "split"],
}
NULLS = [
    f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {_NAMES.get(table, table)}"
    for table, columns in NEEDED.items() for c in columns
]

CARELOG_COLUMNS = (
    "carelogId, caregiverId, franchisorId, agencyId, parentId, startDatetime, endDatetime, clockInActualDatetime, "
    "clockOutActualDatetime, clockInMethod, clockOutMethod, status, split, documentation, generalCommentCharCount"
)
BATCH = f"""WITH {BOTH_RAW}, kept AS (
  SELECT DISTINCT caregiver_id FROM raw_caregiver WHERE NOT ({SHORT_ROW}) AND {txt('caregiver_id')} <> ''
), placed AS (
  SELECT *, {_FIRST.format(key='carelogId')} AS place FROM ({CARELOG_CLEAN})
  WHERE carelogId <> '' AND caregiverId IN (SELECT caregiver_id FROM kept)
) SELECT {CARELOG_COLUMNS} FROM placed WHERE place = 1"""

STATEMENTS = {
    "caregiver_clean": f"WITH {RAW_CAREGIVER} {CAREGIVER_CLEAN}",
    "visit_clean": f"WITH {BOTH_RAW} {CARELOG_CLEAN}",
    "dim_franchisor": f"WITH {RAW_CAREGIVER} {FRANCHISOR}",
    "dim_agency": f"WITH {RAW_CAREGIVER} {AGENCY}",
    "dim_location": f"WITH {RAW_CAREGIVER} {LOCATION}",
    "caregiver_admit": f"{LOAD} SELECT * FROM new_caregiver",
    "caregiver_admit_indexed": f"{LOAD} SELECT * FROM new_caregiver",
    "caregiver_duplicates": f"""{LOAD} SELECT * FROM (
      SELECT caregiverId, caregiverId IN (SELECT caregiverId FROM stored_caregiver) AS already_stored,
        count(*) - CASE WHEN caregiverId IN (SELECT caregiverId FROM stored_caregiver) THEN 0 ELSE 1 END AS skipped_rows
      FROM cleaned_caregiver WHERE caregiverId <> '' GROUP BY caregiverId) WHERE skipped_rows > 0""",
    "visit_admit": f"{LOAD} SELECT * FROM new_carelog",
    "visit_admit_indexed": f"{LOAD} SELECT * FROM new_carelog",
    "visit_orphans": f"{LOAD} SELECT carelogId, caregiverId, source_file, row_id FROM orphan",
    "ingest_rejects": f"""{LOAD} SELECT 'caregiver' AS kind, source_file, row_id, 'empty id' AS reason FROM cleaned_caregiver
      WHERE caregiverId = '' UNION ALL
      SELECT 'carelog', source_file, row_id, 'empty id' FROM cleaned_carelog WHERE carelogId = ''""",
    "ingest_metrics": f"{LOAD} {METRICS}",
    "ingest_totals": f"{LOAD} {TOTALS}",
    "source_profile": PROFILE,
    "source_validate": VALIDATE,
    "check_unique_keys": f"{_CHECKED} " + " UNION ALL ".join(UNIQUE),
    "check_foreign_keys": f"{_CHECKED} " + " UNION ALL ".join(FOREIGN),
    "check_not_null": f"{_CHECKED} " + " UNION ALL ".join(NULLS),
    "source_bad_rows": BAD_ROWS,
    "source_bad_rows_split": BAD_ROWS,
    "source_preview": PREVIEW,
    "load_batch": BATCH,
    "ingest_stream": BATCH,
}

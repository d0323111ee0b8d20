"""Caregiver and visit tables derived from the star-schema test tables.

Workers come from ``customer`` and ``nation``, visits from ``orders``, long notes
from whole ``documents`` texts. Every row of the source tables takes part. The
integer formulas are plain SQL text, so the same text can be read by any engine;
only adding minutes to a time is spelled differently.

k is the order key, w the customer key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake import schemas
from visitlake.session import fresh_path, prepare, shuffles_removed
from visitlake.sources.tables import COMPRESSION


def spark_add_minutes(ts: str, n: str) -> str:
    return f"timestampadd(MINUTE, CAST({n} AS INT), {ts})"


EPOCH_DAY = "CAST('1970-01-01 00:00:00' AS {ntz})"
HIRE_DAY = "CAST('2015-01-01 00:00:00' AS {ntz})"

MISSED = (
    "CASE w % 6 WHEN 0 THEN FALSE WHEN 1 THEN k % 3 = 0 WHEN 2 THEN k % 9 = 0 "
    "WHEN 3 THEN k % 15 = 0 WHEN 4 THEN k % 6 = 0 ELSE k % 40 = 0 END"
)
START_MINUTE = "(k * 37) % 1440"
SCHEDULED = "CASE WHEN k % 97 = 0 THEN -30 WHEN k % 113 = 0 THEN 1 ELSE 60 + (k * 53) % 480 END"
SHIFT = "(k * 17) % 41 - 20 - CASE w % 5 WHEN 0 THEN 25 WHEN 1 THEN 12 ELSE 0 END"
WORKED = (
    f"CASE WHEN k % 101 = 0 THEN 1500 WHEN k % 113 = 0 THEN 1300 WHEN k % 103 = 0 THEN 5 "
    f"WHEN k % 107 = 0 THEN -10 WHEN k % 109 = 0 THEN 0 "
    f"ELSE greatest(20, ({SCHEDULED}) + (k * 71) % 241 - 120 + CASE w % 7 WHEN 0 THEN -130 WHEN 1 THEN 0 "
    f"WHEN 2 THEN 60 WHEN 3 THEN 120 WHEN 4 THEN 200 WHEN 5 THEN 300 ELSE -60 END) END"
)
# Every document is the note of at least one visit; ``documents`` is their number.
NEEDS_DOCUMENT = "k < documents OR w % 8 = 5 OR (w % 8 = 7 AND k % 2 = 0)"

_SHORT = "'shift ' || o_orderpriority || ' for ' || c_mktsegment"
_MEDIUM = "'visit to ' || c_name || ' in ' || n_name || ' closed as ' || o_orderpriority"
NOTE = (
    f"CASE WHEN k < documents THEN text WHEN k % 41 = 0 THEN NULL WHEN k % 43 = 0 THEN '' WHEN k % 17 = 0 THEN 'Good' "
    f"WHEN k % 37 = 0 THEN 'routine visit done' "
    f"WHEN {NEEDS_DOCUMENT} THEN text "
    f"WHEN w % 8 = 0 AND k % 2 = 0 THEN o_orderstatus WHEN w % 8 IN (0, 1) THEN o_orderpriority "
    f"WHEN w % 8 = 3 THEN {_MEDIUM} "
    f"WHEN w % 8 IN (4, 7) THEN {_MEDIUM} || ' and then ' || {_SHORT} || ' once more' "
    f"WHEN k % 11 = 0 THEN 'copy ' || {_SHORT} WHEN k % 13 = 0 THEN 'same ' || {_SHORT} ELSE {_SHORT} END"
)
NOTE_LENGTH = (
    "CASE WHEN k % 47 = 0 THEN NULL WHEN k % 53 = 0 THEN 0 WHEN k % 17 = 0 THEN 12 "
    "ELSE length(documentation) END"
)


def visit_time_exprs(add: Callable[[str, str], str]) -> dict[str, str]:
    """The four visit times from k, w and o_orderdate."""
    start = add("o_orderdate", START_MINUTE)
    return {
        "startDatetime": f"CASE WHEN k % 29 = 0 THEN NULL ELSE {start} END",
        "endDatetime": f"CASE WHEN k % 31 = 0 THEN NULL ELSE {add(start, SCHEDULED)} END",
        "clockInActualDatetime": f"CASE WHEN ({MISSED}) OR k % 19 = 0 THEN NULL ELSE {add(start, SHIFT)} END",
        "clockOutActualDatetime": (
            f"CASE WHEN ({MISSED}) OR k % 23 = 0 THEN NULL ELSE {add(start, f'({SHIFT}) + ({WORKED})')} END"
        ),
    }


def caregiver_exprs(add: Callable[[str, str], str], ntz: str) -> dict[str, str]:
    """Caregiver columns from customer joined with nation."""
    return {
        "caregiverId": "'CG' || CAST(w AS STRING)",
        "externalId": "'EXT' || CAST(w AS STRING)",
        "profileId": "'P' || CAST(w AS STRING)",
        "franchisorId": "'F' || CAST(n_regionkey AS STRING)",
        "agencyId": "'A' || CAST(n_nationkey AS STRING)",
        "locationId": "'L' || CAST(w % 50 AS STRING)",
        "firstName": "c_mktsegment",
        "lastName": "c_name",
        "email": "CASE WHEN w % 11 = 0 THEN NULL ELSE 'u' || CAST(w AS STRING) || '@example.com' END",
        "phoneNumber": "CASE WHEN w % 13 = 0 THEN NULL ELSE '555-' || CAST(w AS STRING) END",
        "gender": "CASE w % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE NULL END",
        "applicant": "w % 10 = 0",
        "birthdayDate": add(EPOCH_DAY.format(ntz=ntz), "(w % 10000) * 1440"),
        "onboardingDate": f"CASE WHEN w % 17 = 0 THEN NULL ELSE {add(HIRE_DAY.format(ntz=ntz), '(w % 2000) * 1440')} END",
        "applicantStatus": "'hired'",
        "status": "CASE WHEN w % 4 = 0 THEN 'inactive' ELSE 'active' END",
    }


CARELOG_PLAIN = {
    "carelogId": "'CL' || CAST(k AS STRING)",
    "caregiverId": "'CG' || CAST(w AS STRING)",
    "parentId": "CAST(NULL AS STRING)",
    "clockInMethod": "CASE WHEN k % 2 = 0 THEN 'gps' ELSE 'phone' END",
    "clockOutMethod": "CASE WHEN k % 2 = 0 THEN 'gps' ELSE 'phone' END",
    "status": "o_orderstatus",
    "split": "k % 20 = 0",
}

# Raw rows: the typed columns as text, spoiled by key.
DUPLICATED = "{key} % 20 = 3"


def written_time(column: str, key: str) -> str:
    """A time to the minute in one of many layouts, by key; SQL that both engines read."""
    year, month, day, hour, minute = (f"CAST({part}({column}) AS STRING)" for part in ("year", "month", "day", "hour", "minute"))
    two = {x: f"lpad({x}, 2, '0')" for x in (month, day, hour, minute)}
    names = "January February March April May June July August September October November December".split()
    name = f"CASE month({column}) " + " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(names, 1)) + " END"
    short = f"substr({name}, 1, 3)"
    twelve = f"lpad(CAST((hour({column}) + 11) % 12 + 1 AS STRING), 2, '0')"
    half = f"CASE WHEN hour({column}) < 12 THEN '{{}}' ELSE '{{}}' END"
    clock, clock12 = f"{two[hour]} || ':' || {two[minute]}", f"{twelve} || ':' || {two[minute]}"
    layouts = [
        f"{month} || '/' || {day} || '/' || {year} || ', ' || {clock12} || ':00 ' || {half.format('AM', 'PM')}",
        f"{month} || '/' || {day} || '/' || {year} || ' ' || {clock12} || ' ' || {half.format('am', 'pm')}",
        f"{short} || ' ' || {day} || ' ' || {year} || ' ' || {clock}",
        f"{day} || ' ' || {name} || ' ' || {year} || ' ' || {clock}",
        f"'Tue, ' || {two[day]} || ' ' || {short} || ' ' || {year} || ' ' || {clock} || ':00 GMT'",
        f"'Mon ' || {short} || ' ' || {two[day]} || ' ' || {year} || ' ' || {clock} || ':00'",
        f"{two[month]} || '-' || {two[day]} || '-' || {year} || ' ' || {clock}",
        f"{name} || ' ' || {day} || ', ' || {year} || ' ' || {clock}",
        f"{year} || '/' || {two[month]} || '/' || {two[day]} || ' ' || {clock} || ':00'",
    ]
    return f"CASE {key} % 20 " + " ".join(f"WHEN {k} THEN {layout}" for k, layout in enumerate(layouts)) + f" ELSE CAST({column} AS STRING) END"


def spoiled_time(column: str) -> str:
    return (
        f"CASE WHEN k % 7 = 0 THEN 'None' WHEN k % 11 = 0 THEN '' WHEN k % 13 = 0 THEN 'not-a-date' "
        f"ELSE {written_time(column, 'k')} END"
    )


FLAG_TEXT = "CASE {key} % 5 WHEN 0 THEN 'True' WHEN 1 THEN 'true' WHEN 2 THEN 'FALSE' WHEN 3 THEN 'yes' ELSE '' END"
COUNT_TEXT = (
    "CASE k % 9 WHEN 0 THEN '12' WHEN 1 THEN ' 7 ' WHEN 2 THEN '1e3' WHEN 3 THEN 'abc' WHEN 4 THEN '' "
    "WHEN 5 THEN '0x10' ELSE CAST(generalCommentCharCount AS STRING) END"
)

RAW_CAREGIVER_EXPRS = {
    "franchisor_id": "CASE WHEN w % 101 = 0 THEN NULL WHEN w % 33 = 1 THEN 'c' WHEN w % 33 = 2 THEN 'b-c' ELSE franchisorId END",
    "franchisor_name": "'Franchise ' || franchisorId || ' v' || CAST(w % 7 AS STRING)",
    "agency_id": "CASE WHEN w % 33 = 1 THEN 'a-b' WHEN w % 33 = 2 THEN 'a' ELSE agencyId END",
    "agency_name": "CASE WHEN w % 9 = 0 THEN NULL ELSE 'Agency ' || CAST(w % 5 AS STRING) END",
    "subdomain": "'sub' || CAST(w % 3 AS STRING)",
    "profile_id": "profileId",
    "caregiver_id": "CASE WHEN w % 97 = 5 THEN '' ELSE caregiverId END",
    "external_id": "externalId",
    "first_name": "firstName",
    "last_name": "lastName",
    "email": "CASE WHEN w % 12 = 0 THEN '   ' ELSE email END",
    "phone_number": "phoneNumber",
    "gender": "gender",
    "applicant": FLAG_TEXT.format(key="w"),
    "birthday_date": "CASE WHEN w % 7 = 0 THEN 'None' ELSE CAST(CAST(birthdayDate AS DATE) AS STRING) END",
    "onboarding_date": "CASE WHEN w % 13 = 0 THEN 'not-a-date' ELSE " + written_time("onboardingDate", "w") + " END",
    "locations_id": "CASE WHEN w % 19 = 0 THEN NULL ELSE locationId END",
    "location_name": "CASE WHEN w % 23 = 0 THEN '' ELSE 'Site ' || CAST(w % 50 AS STRING) || ' v' || CAST(w % 3 AS STRING) END",
    "applicant_status": "applicantStatus",
    "status": "status",
    "source_file": "'caregiver_' || CAST(w % 4 AS STRING) || '_' || CAST(CAST((w - w % 100000) / 100000 AS BIGINT) AS STRING) || '.csv'",
    "row_id": "w * 2",
}
RAW_CARELOG_EXPRS = {
    "franchisor_id": "franchisorId",
    "agency_id": "agencyId",
    "carelog_id": "CASE WHEN k % 211 = 9 THEN '' ELSE carelogId END",
    "caregiver_id": "CASE WHEN k % 33 = 7 THEN 'UNKNOWN' || CAST(k % 10 AS STRING) ELSE caregiverId END",
    "parent_id": "parentId",
    "start_datetime": spoiled_time("startDatetime"),
    "end_datetime": "CAST(endDatetime AS STRING)",
    "clock_in_actual_datetime": "CAST(clockInActualDatetime AS STRING)",
    "clock_out_actual_datetime": spoiled_time("clockOutActualDatetime"),
    "clock_in_method": "clockInMethod",
    "clock_out_method": "clockOutMethod",
    "status": "status",
    "split": FLAG_TEXT.format(key="k"),
    "documentation": "documentation",
    "general_comment_char_count": COUNT_TEXT,
    "source_file": "'carelog_' || CAST(k % 3 AS STRING) || '_' || CAST(CAST((k - k % 500000) / 500000 AS BIGINT) AS STRING) || '.csv'",
    "row_id": "k * 2",
}


def _columns(df: DataFrame, exprs: dict[str, str], *keep: str) -> DataFrame:
    return df.select(*[F.expr(e).alias(name) for name, e in exprs.items()], *keep)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer").withColumn("w", F.col("c_custkey"))
    nation = read_table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey)


def derive_caregivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(_workers(spark, sf_dir), caregiver_exprs(spark_add_minutes, "TIMESTAMP_NTZ"), "w")


def derive_carelogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    size = documents.agg(F.count("*").alias("documents"))
    workers = _workers(spark, sf_dir).select(
        "w", "c_name", "c_mktsegment", "n_name",
        F.expr("'F' || CAST(n_regionkey AS STRING)").alias("franchisorId"),
        F.expr("'A' || CAST(n_nationkey AS STRING)").alias("agencyId"),
    )
    source = read_table(spark, sf_dir, "orders")
    orders = source.withColumns({"k": F.col("o_orderkey"), "w": F.col("o_custkey")})
    # One row, hence a safe broadcast; the documents themselves are joined by key.
    visits = orders.join(workers, "w").crossJoin(F.broadcast(size))
    # Visits without a document get keys of their own, lest they all meet in one partition.
    visits = visits.withColumn("doc_id", F.expr(f"CASE WHEN {NEEDS_DOCUMENT} THEN k % documents ELSE -1 - k END"))
    noted = visits.join(documents, "doc_id", "left").withColumn("documentation", F.expr(NOTE))
    exprs = CARELOG_PLAIN | visit_time_exprs(spark_add_minutes)
    length = F.expr(NOTE_LENGTH).cast("int").alias("generalCommentCharCount")
    rows = _columns(noted, exprs, "franchisorId", "agencyId", "documentation", length, "k")
    return rows.select(*schemas.CARELOG.fieldNames(), "k")


# Derived tables and files written by this process: (application, source folder, table) -> folder.
_written: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, derive: Callable) -> DataFrame:
    """A derived table, written to the shared folder on first use.

    The reports are meant for stored tables, which they may scan more than once;
    deriving the rows anew for each scan would cost more than the reports do.
    """
    key = (prepare(spark).sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = fresh_path(spark, f"derived-{name}")
        rows = derive(spark, sf_dir)
        with shuffles_removed(spark):
            rows.write.option("compression", COMPRESSION).parquet(path)
        _written[key] = path
    return spark.read.parquet(_written[key])


def _at_hand(spark: SparkSession, sf_dir: str, name: str, derive: Callable) -> DataFrame:
    """A derived table for a single reader: as it was written, if it was, and not written for this."""
    known = _written.get((prepare(spark).sparkContext.applicationId, sf_dir, name))
    return spark.read.parquet(known) if known else derive(spark, sf_dir)


def caregivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "caregiver", derive_caregivers).drop("w")


def carelogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "carelog", derive_carelogs).drop("k")


def derive_raw_caregivers(spark: SparkSession, sf_dir: str, table: Callable = _stored) -> DataFrame:
    typed = table(spark, sf_dir, "caregiver", derive_caregivers)
    return _with_origin(_mark_second(_columns(typed, RAW_CAREGIVER_EXPRS, _copies("w")), "first_name"))


def derive_raw_carelogs(spark: SparkSession, sf_dir: str, table: Callable = _stored) -> DataFrame:
    typed = table(spark, sf_dir, "carelog", derive_carelogs)
    return _with_origin(_mark_second(_columns(typed, RAW_CARELOG_EXPRS, _copies("k")), "status"))


def raw_caregivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caregiver file rows as text; every twentieth id appears again under another name."""
    return _stored(spark, sf_dir, "raw-caregiver", derive_raw_caregivers)


def raw_carelogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit file rows as text; some for unknown workers, every twentieth id twice."""
    return _stored(spark, sf_dir, "raw-carelog", derive_raw_carelogs)


def _copies(key: str):
    duplicated = DUPLICATED.format(key=key)
    return F.explode(F.expr(f"CASE WHEN {duplicated} THEN array(0, 1) ELSE array(0) END")).alias("copy")


def _mark_second(rows: DataFrame, field: str) -> DataFrame:
    second = F.when(F.col("copy") == 1, F.lit("SECOND")).otherwise(F.col(field))
    return rows.withColumns({field: second, "row_id": F.col("row_id") + F.col("copy")}).drop("copy")


def _with_origin(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"modified": F.lit(None).cast("timestamp"), "block_start": F.lit(0).cast("bigint"), schemas.CORRUPT: F.lit(None).cast("string")}
    )


# What an earlier load is taken to have stored already.
STORED_SEGMENT = "HOUSEHOLD"
STORED_BEFORE = "1996-01-01"
STORED_REGION = "AFRICA"


def stored_caregivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caregivers(spark, sf_dir).where(F.col("firstName") == STORED_SEGMENT)


def stored_carelogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit(STORED_BEFORE).cast("timestamp_ntz"))
    return orders.select(F.expr("'CL' || CAST(o_orderkey AS STRING)").alias("carelogId"))


def stored_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dimension rows of one region, taken to be stored already."""
    nation, region = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    known = nation.join(region.where(F.col("r_name") == STORED_REGION), F.col("n_regionkey") == F.col("r_regionkey"))
    keys = {
        "franchisor": {"franchisorId": "'F' || CAST(r_regionkey AS STRING)"},
        "agency": {
            "agencyId": "'A' || CAST(n_nationkey AS STRING)",
            "franchisorId": "'F' || CAST(n_regionkey AS STRING)",
        },
        "location": {"locationId": "'L' || CAST(n_nationkey AS STRING)"},
    }
    return {name: _columns(known, exprs).distinct() for name, exprs in keys.items()}


# File rows of the wrong length: the last value missing, or one too many.
SHORT_ROW, LONG_ROW = "row_id % 50 = 20", "row_id % 60 = 40"


# What the constraint checks are to find: parents left out, and rows without a needed value.
MISSING_PARENTS = {"franchisor": "franchisorId = 'F1'", "agency": "agencyId = 'A3'", "location": "locationId = 'L7'"}
NO_VALUE = {"caregiver": ("profileId", "caregiverId LIKE '%77'"), "carelog": ("franchisorId", "carelogId LIKE '%13'")}


def spoiled(rows: DataFrame, table: str) -> DataFrame:
    if table in MISSING_PARENTS:
        return rows.where(~F.expr(MISSING_PARENTS[table]))
    column, condition = NO_VALUE[table]
    return rows.withColumn(column, F.when(~F.expr(condition), F.col(column)))


# Files beside the derived ones: without a byte, and with a repeated column. Neither is a caregiver or visit file.
EMPTY_FILE, TWICE_FILE = "extra_empty.csv", ("extra_twice.csv", "a,b,a\n1,2,3\n")
#: Rows of a source table whose files are written at once, about: what is shuffled for them lies on disk until then.
ROWS_PER_ROUND = 4_000_000


def mixed_files(spark: SparkSession, sf_dir: str) -> str:
    """The folder of ``write_mixed_files``, written on first use like a derived table: nobody changes a file in it."""
    key = (prepare(spark).sparkContext.applicationId, sf_dir, "mixed-files")
    if key not in _written:
        _written[key] = write_mixed_files(spark, sf_dir, fresh_path(spark, "raw-files"))
    return _written[key]


def write_mixed_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Write the raw rows as CSV files into one folder, a file per name in ``source_file``, and return it.

    Caregiver rows are written as plain lines, some with the wrong number of
    values. Visit rows are quoted where needed and hold line breaks.
    """
    fields = schemas.RAW_CAREGIVER
    values = [F.when(F.contains(c, F.lit(",")), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(F.coalesce(c, F.lit(""))) for c in map(F.col, fields)]
    line = F.when(F.expr(SHORT_ROW), F.concat_ws(",", *values[:-1])).when(
        F.expr(LONG_ROW), F.concat_ws(",", *values, F.lit("surplus"))
    ).otherwise(F.concat_ws(",", *values))
    place = ["source_file", "row_id"]
    plain = {"header": True, "sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines = _raw_at_hand(spark, sf_dir, "caregiver", derive_raw_caregivers).select(line.alias(",".join(fields)), *place)
    _write_files(lines, f"{folder}/written/caregiver", plain, _rounds(spark, sf_dir, "customer"))
    quoted = plain | {"sep": ",", "quote": '"', "escape": '"'}
    visits = _raw_at_hand(spark, sf_dir, "carelog", derive_raw_carelogs).select(*schemas.RAW_CARELOG, *place)
    _write_files(visits, f"{folder}/written/carelog", quoted, _rounds(spark, sf_dir, "orders"))
    _gather(spark, folder)
    return f"{folder}/files"


def _raw_at_hand(spark: SparkSession, sf_dir: str, name: str, derive: Callable) -> DataFrame:
    """Raw rows to be read once, by the files: neither they nor the typed rows below are written as tables for that."""
    return _at_hand(spark, sf_dir, f"raw-{name}", lambda s, d: derive(s, d, _at_hand))


def _rounds(spark: SparkSession, sf_dir: str, name: str) -> int:
    """In how many rounds the files of a source table are written, by its number of rows."""
    return max(1, -(-read_table(spark, sf_dir, name).count() // ROWS_PER_ROUND))


def _write_files(rows: DataFrame, folder: str, options: dict, rounds: int) -> None:
    """Write a file per ``source_file``, its rows by ``row_id``.

    Files are dealt to rounds by their names. A round's rows are picked before they are
    joined, and what it shuffles is removed before the next, so that the disk never holds
    all rows a second time beside their files.
    """
    for number in range(rounds):
        mine = rows.where(F.pmod(F.xxhash64("source_file"), F.lit(rounds)) == number) if rounds > 1 else rows
        in_order = mine.repartition("source_file").sortWithinPartitions("source_file", "row_id").drop("row_id")
        with shuffles_removed(rows.sparkSession):
            in_order.write.mode("append").options(**options).partitionBy("source_file").csv(folder)


def _gather(spark: SparkSession, folder: str) -> None:
    """Give the written files the names of the partitions they lie in, all in one folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    store.mkdirs(path(f"{folder}/files"))
    for status in store.globStatus(path(f"{folder}/written/*/source_file=*/part-*")):
        name = status.getPath().getParent().getName().split("=", 1)[1]
        store.rename(status.getPath(), path(f"{folder}/files/{name}"))
    for name, content in ((EMPTY_FILE, ""), TWICE_FILE):
        out = store.create(path(f"{folder}/files/{name}"))
        out.write(bytearray(content.encode()))
        out.close()

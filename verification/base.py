"""Common table expressions and rounding for the check statements."""

from __future__ import annotations

from visitlake import schemas
from visitlake.sources import derived


def add_minutes(ts: str, n: str) -> str:
    return f"({ts} + to_minutes(CAST({n} AS BIGINT)))"


def select_list(exprs: dict[str, str]) -> str:
    return ", ".join(f'({e}) AS "{name}"' for name, e in exprs.items())


WORKERS = "SELECT c.*, n.*, c_custkey AS w FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"
CAREGIVER = f"caregiver AS (SELECT w, {select_list(derived.caregiver_exprs(add_minutes, 'TIMESTAMP'))} FROM ({WORKERS}))"
TIMES = derived.visit_time_exprs(add_minutes)
ORDERS = "SELECT *, o_orderkey AS k, o_custkey AS w FROM orders"
CARELOG_TIMES = (
    f"carelog AS (SELECT 'CL' || CAST(k AS STRING) AS carelogId, 'CG' || CAST(w AS STRING) AS caregiverId, "
    f"{select_list(TIMES)} FROM ({ORDERS}))"
)
_PLAIN = select_list(derived.CARELOG_PLAIN)
CARELOG = f"""noted AS (
  SELECT o.*, p.c_name, p.c_mktsegment, p.n_name,
    'F' || CAST(p.n_regionkey AS STRING) AS franchisorId, 'A' || CAST(p.n_nationkey AS STRING) AS agencyId, d.text
  FROM (SELECT t.*, n.documents FROM ({ORDERS}) t CROSS JOIN (SELECT count(*) AS documents FROM documents) n) o
  JOIN ({WORKERS}) p ON p.c_custkey = o.o_custkey
  LEFT JOIN documents d
    ON d.doc_id = CASE WHEN o.k < o.documents OR o.w % 8 = 5 OR (o.w % 8 = 7 AND o.k % 2 = 0) THEN o.k % o.documents END
), lettered AS (
  SELECT *, {_PLAIN}, {select_list(TIMES)}, ({derived.NOTE}) AS documentation FROM noted
), carelog AS (
  SELECT k, {', '.join(c for c in schemas.CARELOG.fieldNames() if c != 'generalCommentCharCount')},
    CAST({derived.NOTE_LENGTH} AS INTEGER) AS generalCommentCharCount
  FROM lettered
)"""

_TWICE = "CROSS JOIN (VALUES (0), (1)) AS copies(copy) WHERE copy = 0 OR {key} % 20 = 3"


def _raw(table: str, key: str, exprs: dict[str, str], renamed: str) -> str:
    exprs = exprs | {
        renamed: f"CASE WHEN copy = 1 THEN 'SECOND' ELSE {exprs[renamed]} END",
        "row_id": f"{exprs['row_id']} + copy",
    }
    return f"SELECT {select_list(exprs)} FROM {table} {_TWICE.format(key=key)}"


RAW_CAREGIVER = (
    f"{CAREGIVER}, raw_caregiver AS ({_raw('caregiver', 'w', derived.RAW_CAREGIVER_EXPRS, 'first_name')})"
)
RAW_CARELOG = f"{CARELOG}, raw_carelog AS ({_raw('carelog', 'k', derived.RAW_CARELOG_EXPRS, 'status')})"

I, O, S, E = "clockInActualDatetime", "clockOutActualDatetime", "startDatetime", "endDatetime"


def us(start: str, end: str) -> str:
    return f"(epoch_us({end}) - epoch_us({start}))"


HOUR = 3600000000


def cents(p: str, q: str) -> str:
    """round(p / q, 2) * 100 in whole numbers, half away from zero."""
    p, q = f"CAST({p} AS HUGEINT)", f"CAST({q} AS HUGEINT)"
    return (
        f"CAST(CASE WHEN {q} = 0 THEN NULL WHEN {p} < 0 THEN -((-200 * {p} + {q}) // (2 * {q})) "
        f"ELSE (200 * {p} + {q}) // (2 * {q}) END AS BIGINT)"
    )


def rate(part: str, base: str) -> str:
    return cents(f"100 * ({part})", base)


def hrs(micros: str, count: str = "1") -> str:
    return cents(micros, f"({count})::HUGEINT * {HOUR}")


def dbl(c: str, name: str | None = None) -> str:
    return f"CAST({c} AS DOUBLE) / 100.0" + (f" AS {name}" if name else "")


def two(c: str) -> str:
    """A number of hundredths as text with two decimals."""
    return f"printf('%.2f', {c} / 100.0)"


def guarded(x: str) -> str:
    return f"CAST(floor(({x}) * 100 + (0.5 + 1e-9)) AS DOUBLE) / 100.0"

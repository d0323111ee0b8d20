"""Check statements for the visit features and the eight reports."""

from __future__ import annotations

import re

from verification.base import (
    CAREGIVER, CARELOG, CARELOG_TIMES, HOUR, E, I, O, S, cents, dbl, guarded, hrs, rate, two, us,
)

ACT, SCH = us(I, O), us(S, E)
DONE = f"({I} IS NOT NULL OR {O} IS NOT NULL)"
BOTH = f"({I} IS NOT NULL AND {O} IS NOT NULL)"
NONE = f"({I} IS NULL AND {O} IS NULL)"
MISS = f"(({S} IS NOT NULL OR {E} IS NOT NULL) AND {NONE})"
LATE = f"({S} IS NOT NULL AND {I} IS NOT NULL AND {I} > {S})"
EARLY = f"({E} IS NOT NULL AND {O} IS NOT NULL AND {O} < {E})"
WORKED = f"({BOTH} AND {I} < {O})"
PLANNED = f"({S} IS NOT NULL AND {E} IS NOT NULL AND {S} < {E})"
DOCUMENTED = "(documentation IS NOT NULL AND documentation <> '' AND generalCommentCharCount > 0)"
WHO = "c.firstName || ' ' || c.lastName AS caregiver_name, c.email, c.phoneNumber"


def n(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


VISIT_FACTS = f"""WITH {CARELOG_TIMES}
SELECT carelogId, caregiverId, {ACT} AS actual_us, {SCH} AS scheduled_us,
  CASE WHEN {WORKED} AND {SCH} IS NOT NULL THEN greatest(0, {ACT} - {SCH}) END AS overtime_us,
  {DONE} AS done, {MISS} AS missed, {LATE} AS late, {EARLY} AS early,
  CAST({I} AS DATE) AS visit_date, CAST(extract(dow FROM {I}) AS INTEGER) AS day_of_week,
  CAST(extract(hour FROM {I}) AS INTEGER) AS start_hour
FROM carelog"""

_FLAGS = f"""flags AS (
  SELECT carelogId, caregiverId,
    CASE WHEN {WORKED} THEN {ACT} END AS actual_us,
    CASE WHEN {PLANNED} THEN {SCH} END AS scheduled_us,
    CASE WHEN {WORKED} AND {PLANNED} THEN {ACT} - {SCH} END AS difference_us,
    CASE WHEN {NONE} THEN 'NO_ACTUAL_TIMES' WHEN {I} IS NULL THEN 'MISSING_CLOCK_IN'
      WHEN {O} IS NULL THEN 'MISSING_CLOCK_OUT' WHEN {I} >= {O} THEN 'INVALID_DURATION'
      WHEN {ACT} > 24 * {HOUR} THEN 'EXCESSIVE_DURATION' WHEN {ACT} * 10 < {HOUR} THEN 'TOO_SHORT_DURATION'
      ELSE 'VALID_DURATION' END AS data_quality_flag
  FROM carelog WHERE {DONE})"""
DURATION_FLAGS = f"WITH {CARELOG_TIMES}, {_FLAGS} SELECT * FROM flags"


def _by_length(values: list[object], none: object) -> str:
    c = "generalCommentCharCount"
    vs, sh, m, lo, vl = (repr(v) for v in values)
    return (
        f"CASE WHEN documentation IS NULL OR documentation = '' OR {c} IS NULL OR {c} = 0 THEN {none!r} "
        f"WHEN {c} < 10 THEN {vs} WHEN {c} < 50 THEN {sh} WHEN {c} < 100 THEN {m} WHEN {c} < 200 THEN {lo} ELSE {vl} END"
    )


_COMMENTS = f"""comments AS (
  SELECT carelogId, caregiverId, generalCommentCharCount AS comment_length, CAST({I} AS DATE) AS visit_date,
    {ACT} AS actual_us,
    {_by_length(['VERY_SHORT', 'SHORT', 'MEDIUM', 'LONG', 'VERY_LONG'], 'NO_COMMENT')} AS comment_category,
    {_by_length([1, 2, 3, 4, 5], 0)} AS comment_detail_score,
    documentation <> '' AS has_comment,
    {cents(f"generalCommentCharCount::HUGEINT * {HOUR}", ACT)} AS chars_per_hour_h,
    status AS visit_status, CAST({I} AS DATE) <> CAST({O} AS DATE) AS overnight_shift,
    extract(dow FROM {I}) IN (0, 6) AS weekend_shift
  FROM carelog WHERE {WORKED} AND {DOCUMENTED})"""
COMMENT_CATEGORIES = f"""WITH {CARELOG}, {_COMMENTS}
SELECT * EXCLUDE (chars_per_hour_h), {dbl('chars_per_hour_h', 'chars_per_hour')} FROM comments"""

_T, _N = "documentation", "generalCommentCharCount"
_RUNGS = [
    (f"{_T} IS NULL OR {_T} = ''", "MISSING_DOCUMENTATION", 10),
    (f"{_N} < 5", "VERY_SHORT_DOCUMENTATION", 8),
    (f"{_N} < 10", "SHORT_DOCUMENTATION", 6),
    (f"{_N} > 1000", "EXCESSIVELY_LONG", 7),
    (f"lower({_T}) IN ('ok', 'fine', 'good', 'completed', 'done', 'finished')", "GENERIC_COMMENT", 5),
    (f"length({_T}) > 0 AND {_N} = 0", "LENGTH_MISMATCH", 9),
    (f"{_T} LIKE '%copy%' OR {_T} LIKE '%paste%'", "SUSPECTED_COPY_PASTE", 8),
    (f"{_T} LIKE '%same%' OR {_T} LIKE '%identical%'", "DUPLICATE_CONTENT_SUSPECTED", 7),
    (f"regexp_full_match({_T}, '[A-Za-z\\s]+') AND length({_T}) < 20", "TOO_GENERIC", 4),
]
_ANOMALIES = (
    f"anomalies AS (SELECT carelogId, caregiverId, CAST({I} AS DATE) AS visit_date, CASE "
    + " ".join(f"WHEN {c} THEN '{kind}'" for c, kind, _ in _RUNGS)
    + " ELSE 'NORMAL_DOCUMENTATION' END AS anomaly_type, CASE "
    + " ".join(f"WHEN {c} THEN {score}" for c, _, score in _RUNGS)
    + f" ELSE 1 END AS suspicion_score FROM carelog WHERE {WORKED} AND {DOCUMENTED})"
)
DOC_ANOMALIES = f"WITH {CARELOG}, {_ANOMALIES} SELECT * FROM anomalies"

_STATS = f"""durations AS (
  SELECT {ACT} AS actual_us FROM carelog WHERE {WORKED} AND {ACT} BETWEEN 900000000 AND 86400000000
), stats AS (
  SELECT avg(actual_us) AS mean_us, stddev_samp(actual_us) AS deviation_us,
    quantile_cont(actual_us::DOUBLE, 0.25) AS q1_us, quantile_cont(actual_us::DOUBLE, 0.75) AS q3_us FROM durations)"""
DURATION_STATS = f"""WITH {CARELOG_TIMES}, {_STATS}
SELECT round(mean_us / 60000000, 6) AS mean_minutes, round(deviation_us / 60000000, 6) AS deviation_minutes,
  q1_us / 60000000 AS q1_minutes, q3_us / 60000000 AS q3_minutes FROM stats"""

_OVERTIME = f"""worked AS (
  SELECT carelogId, caregiverId, {ACT} AS actual_us, {SCH} AS scheduled_us, greatest(0, {ACT} - {SCH}) AS overtime_us,
    {cents(f"100::HUGEINT * greatest(0, {ACT} - {SCH})", f"{SCH}::HUGEINT * 12960000")} AS overtime_percentage_h,
    CAST({I} AS DATE) AS visit_date, CAST(extract(dow FROM {I}) AS INTEGER) AS day_of_week,
    CAST(extract(hour FROM {I}) AS INTEGER) AS start_hour, CAST(extract(month FROM {I}) AS INTEGER) AS visit_month,
    CASE WHEN {ACT} > 12 * {HOUR} THEN 'EXTENDED_SHIFT' WHEN {ACT} > 8 * {HOUR} THEN 'LONG_SHIFT'
      WHEN {ACT} > 4 * {HOUR} THEN 'NORMAL_SHIFT' ELSE 'SHORT_SHIFT' END AS shift_type,
    CASE WHEN extract(hour FROM {I}) < 6 THEN 'EARLY_MORNING' WHEN extract(hour FROM {I}) < 12 THEN 'MORNING'
      WHEN extract(hour FROM {I}) < 18 THEN 'AFTERNOON' WHEN extract(hour FROM {I}) < 24 THEN 'EVENING'
      ELSE 'NIGHT' END AS time_period,
    CASE WHEN extract(dow FROM {I}) IN (0, 6) THEN 'WEEKEND' ELSE 'WEEKDAY' END AS day_type
  FROM carelog WHERE {WORKED} AND {PLANNED})"""
OVERTIME_ROWS = f"""WITH {CARELOG_TIMES}, {_OVERTIME}
SELECT * EXCLUDE (overtime_percentage_h), {dbl('overtime_percentage_h', 'overtime_percentage')} FROM worked"""

RELIABILITY = f"""WITH {CAREGIVER}, {CARELOG_TIMES}, g AS (
  SELECT c.caregiverId, {WHO}, c.status AS caregiver_status,
    count(*) AS n, {n(DONE)} AS done, {n(MISS)} AS miss, {n(LATE)} AS late,
    {n(f"{S} IS NOT NULL AND {I} IS NOT NULL")} AS ld, {n(EARLY)} AS early,
    {n(f"{E} IS NOT NULL AND {O} IS NOT NULL")} AS ed,
    max({S}) FILTER (WHERE {MISS}) AS last_missed_visit, max({I}) FILTER (WHERE {LATE}) AS last_late_arrival,
    max({O}) FILTER (WHERE {EARLY}) AS last_early_departure
  FROM caregiver c JOIN carelog v ON c.caregiverId = v.caregiverId
  GROUP BY c.caregiverId, c.firstName, c.lastName, c.email, c.phoneNumber, c.status
), r AS (
  SELECT *, {rate('miss', 'n')} AS a, {rate('late', 'ld')} AS l, {rate('early', 'ed')} AS e, {rate('done', 'n')} AS co,
    {cents('50 * miss * ld::HUGEINT * ed + 30 * late * n::HUGEINT * ed + 20 * early * n::HUGEINT * ld', 'n::HUGEINT * ld * ed')} AS sc
  FROM g WHERE n >= 5 AND (20 * miss > n OR 5 * late > ld OR 5 * early > ed OR 10 * done < 7 * n)
)
SELECT caregiverId, caregiver_name, email, phoneNumber, caregiver_status, n AS total_scheduled_visits,
  done AS completed_visits, miss AS missed_visits_count, late AS late_arrivals_count, early AS early_departures_count,
  {dbl('a', 'absenteeism_rate')}, {dbl('l', 'late_arrival_rate')}, {dbl('e', 'early_departure_rate')},
  {dbl('co', 'completion_rate')}, {dbl('sc', 'severity_score')},
  CASE WHEN 5 * miss > n THEN 'CRITICAL' WHEN 10 * miss > n THEN 'HIGH' WHEN 20 * miss > n THEN 'MEDIUM' ELSE 'LOW' END
    AS severity_level,
  CASE WHEN 20 * miss > 3 * n THEN 'HIGH_ABSENTEEISM' WHEN 10 * late > 3 * ld THEN 'FREQUENT_LATE_ARRIVALS'
    WHEN 10 * early > 3 * ed THEN 'FREQUENT_EARLY_DEPARTURES' WHEN 10 * done < 7 * n THEN 'LOW_COMPLETION_RATE'
    ELSE 'MIXED_ISSUES' END AS primary_issue_type,
  last_missed_visit, last_late_arrival, last_early_departure
FROM r ORDER BY sc DESC NULLS FIRST, a DESC NULLS FIRST, l DESC NULLS FIRST, e DESC NULLS FIRST, caregiverId LIMIT 50"""

_V = "data_quality_flag = 'VALID_DURATION'"
VISIT_DURATION = f"""WITH {CAREGIVER}, {CARELOG_TIMES}, {_FLAGS}, g AS (
  SELECT c.caregiverId, c.firstName || ' ' || c.lastName AS caregiver_name, count(*) AS total_visits,
    {n(_V)} AS valid_duration_visits, {n("data_quality_flag <> 'VALID_DURATION'")} AS problematic_visits,
    {n("data_quality_flag = 'NO_ACTUAL_TIMES'")} AS no_actual_times,
    {n("data_quality_flag = 'MISSING_CLOCK_IN'")} AS missing_clock_in,
    {n("data_quality_flag = 'MISSING_CLOCK_OUT'")} AS missing_clock_out,
    {n("data_quality_flag = 'INVALID_DURATION'")} AS invalid_duration,
    {n("data_quality_flag = 'EXCESSIVE_DURATION'")} AS excessive_duration,
    {n("data_quality_flag = 'TOO_SHORT_DURATION'")} AS too_short_duration,
    {hrs(f"sum(actual_us) FILTER (WHERE {_V})", n(_V))} AS av,
    {hrs("sum(scheduled_us)", "count(scheduled_us)")} AS sv, {hrs("sum(difference_us)", "count(difference_us)")} AS dv,
    {rate(n(_V), "count(*)")} AS q,
    {hrs(f"min(actual_us) FILTER (WHERE {_V})")} AS mn, {hrs(f"max(actual_us) FILTER (WHERE {_V})")} AS mx,
    {cents(f"2 * quantile_cont(actual_us::DOUBLE, 0.5) FILTER (WHERE {_V})", f"2 * {HOUR}")} AS md,
    {guarded(f"stddev_samp(actual_us) FILTER (WHERE {_V}) / {HOUR}.0")} AS stddev_actual_duration_hours,
    {n(f"{_V} AND actual_us < {HOUR}")} AS visits_under_1_hour,
    {n(f"{_V} AND actual_us BETWEEN {HOUR} AND 4 * {HOUR}")} AS visits_1_to_4_hours,
    {n(f"{_V} AND actual_us BETWEEN 4 * {HOUR} AND 8 * {HOUR}")} AS visits_4_to_8_hours,
    {n(f"{_V} AND actual_us > 8 * {HOUR}")} AS visits_over_8_hours
  FROM caregiver c JOIN flags f ON c.caregiverId = f.caregiverId
  GROUP BY c.caregiverId, c.firstName || ' ' || c.lastName HAVING count(*) >= 3
)
SELECT * EXCLUDE (av, sv, dv, q, mn, mx, md), {dbl('av', 'avg_actual_duration_hours')},
  {dbl('sv', 'avg_scheduled_duration_hours')}, {dbl('dv', 'avg_duration_difference_hours')},
  {dbl('q', 'data_quality_percentage')}, {dbl('mn', 'min_actual_duration_hours')},
  {dbl('mx', 'max_actual_duration_hours')}, {dbl('md', 'median_actual_duration_hours')}
FROM g ORDER BY av DESC NULLS LAST, q DESC NULLS FIRST, caregiverId LIMIT 50"""

TOP_PERFORMANCE = f"""WITH {CAREGIVER}, {CARELOG_TIMES}, g AS (
  SELECT c.caregiverId, {WHO}, c.status AS caregiver_status, count(*) AS n, {n(DONE)} AS act, {n(BOTH)} AS comp,
    {n(f"{DONE} AND NOT {BOTH}")} AS part, {n(NONE)} AS nos, coalesce(sum({ACT}), 0) AS us,
    {n(f"{I} <= {S} AND {O} >= {E}")} AS punctual_visits,
    min({I}) AS first_actual_visit, max({O}) AS last_actual_visit, count(DISTINCT CAST({I} AS DATE)) AS days
  FROM caregiver c JOIN carelog v ON c.caregiverId = v.caregiverId
  GROUP BY c.caregiverId, c.firstName, c.lastName, c.email, c.phoneNumber, c.status HAVING count(*) >= 3
), r AS (SELECT *, {hrs('us')} AS tw FROM g)
SELECT caregiverId, caregiver_name, email, phoneNumber, caregiver_status, n AS total_scheduled_visits,
  act AS actual_visits, comp AS complete_visits, part AS partial_visits, nos AS no_show_visits,
  {dbl(rate('act', 'n'), 'completion_rate')}, {dbl(rate('comp', 'n'), 'complete_visit_rate')},
  {dbl('tw', 'total_work_hours')}, {dbl(hrs('us', 'comp'), 'avg_work_hours')}, punctual_visits,
  first_actual_visit, last_actual_visit, days AS actual_active_days, {dbl(hrs('us', 'days'), 'avg_hours_per_day')}
FROM r ORDER BY act DESC, comp DESC, tw DESC, caregiverId LIMIT 50"""

_LOW, _HIGH = "q1_us - 1.5 * (q3_us - q1_us)", "q3_us + 1.5 * (q3_us - q1_us)"
ABNORMAL = f"""WITH {CAREGIVER}, {CARELOG_TIMES}, {_STATS}, v AS (
  SELECT c.caregiverId, {WHO}, carelogId, {S} AS scheduled_start, {E} AS scheduled_end, {I} AS actual_start,
    {O} AS actual_end, {ACT} AS a, {SCH} AS s, mean_us, deviation_us,
    CASE WHEN {ACT} < 900000000 THEN 'EXTREMELY_SHORT' WHEN {ACT} > 86400000000 THEN 'EXTREMELY_LONG'
      WHEN {ACT} < {_LOW} THEN 'STATISTICALLY_SHORT' WHEN {ACT} > {_HIGH} THEN 'STATISTICALLY_LONG'
      WHEN {ACT} < mean_us - 2 * deviation_us THEN 'SIGNIFICANTLY_SHORT'
      WHEN {ACT} > mean_us + 2 * deviation_us THEN 'SIGNIFICANTLY_LONG' ELSE 'NORMAL' END AS atypical_type
  FROM caregiver c JOIN carelog v ON c.caregiverId = v.caregiverId CROSS JOIN stats WHERE {WORKED}
), r AS (
  SELECT *, CASE WHEN atypical_type LIKE 'EXTREMELY%' THEN 'CRITICAL' WHEN atypical_type LIKE 'STATISTICALLY%' THEN 'HIGH'
      WHEN atypical_type LIKE 'SIGNIFICANTLY%' THEN 'MEDIUM' ELSE 'LOW' END AS severity_level,
    CASE WHEN deviation_us > 0 THEN {guarded('abs(a - mean_us) / deviation_us')} END AS z_score,
    {cents('a', '60000000')} AS am
  FROM v WHERE atypical_type <> 'NORMAL'
)
SELECT caregiverId, caregiver_name, email, phoneNumber, carelogId, scheduled_start, scheduled_end, actual_start, actual_end,
  {dbl('am', 'actual_duration_minutes')}, {dbl(hrs('a'), 'actual_duration_hours')},
  {dbl(cents('s', '60000000'), 'scheduled_duration_minutes')},
  {dbl(cents('a - s', '60000000'), 'duration_difference_minutes')},
  atypical_type, severity_level, z_score,
  CASE atypical_type WHEN 'EXTREMELY_SHORT' THEN 'Extremely short visit (less than 15 minutes)'
    WHEN 'EXTREMELY_LONG' THEN 'Extremely long visit (more than 24 hours)'
    WHEN 'STATISTICALLY_SHORT' THEN 'Statistically short visit (below Q1 - 1.5*IQR)'
    WHEN 'STATISTICALLY_LONG' THEN 'Statistically long visit (above Q3 + 1.5*IQR)'
    WHEN 'SIGNIFICANTLY_SHORT' THEN 'Significantly short visit (more than 2 standard deviations below mean)'
    WHEN 'SIGNIFICANTLY_LONG' THEN 'Significantly long visit (more than 2 standard deviations above mean)'
    ELSE 'Normal duration' END AS atypical_description
FROM r ORDER BY severity_level DESC NULLS FIRST, z_score DESC NULLS FIRST, am DESC NULLS FIRST, carelogId LIMIT 100"""

_A0 = "CAST((av + 50) // 100 AS VARCHAR) || ' characters'"
COMMENT_DETAIL = f"""WITH {CAREGIVER}, {CARELOG}, {_COMMENTS}, g AS (
  SELECT c.caregiverId, {WHO}, c.status, count(*) AS n, sum(comment_length) AS chars, max(comment_length) AS mxl,
    min(comment_length) AS mnl, {n("comment_category = 'VERY_LONG'")} AS vl, {n("comment_category = 'LONG'")} AS lo,
    {n("comment_category = 'MEDIUM'")} AS me, {n("comment_category = 'SHORT'")} AS sh,
    {n("comment_category = 'VERY_SHORT'")} AS vs, sum(comment_detail_score) AS ds, sum(actual_us) AS us,
    max(actual_us) AS mxu, min(actual_us) AS mnu, sum(chars_per_hour_h) AS ps, count(chars_per_hour_h) AS pc,
    max(chars_per_hour_h) AS mxp, {n('overnight_shift')} AS overnight_comments, {n('weekend_shift')} AS weekend_comments,
    min(visit_date) AS first_comment_date, max(visit_date) AS last_comment_date,
    count(DISTINCT visit_date) AS comment_active_days
  FROM caregiver c JOIN comments v ON c.caregiverId = v.caregiverId
  GROUP BY c.caregiverId, c.firstName, c.lastName, c.email, c.phoneNumber, c.status HAVING count(*) >= 3
), r AS (
  SELECT *, {cents('chars', 'n')} AS av, {rate('lo + vl', 'n')} AS dp, {rate('me', 'n')} AS mp, {rate('sh + vs', 'n')} AS bp,
    {cents('ds', 'n')} AS sc, {cents('(4 * vl + 3 * lo + 2 * me) * n::HUGEINT + sh', '2 * n')} AS cs,
    {cents('40 * chars + 3000 * (lo + vl) + 1000 * (2 * (lo + vl)) + 1500 * me + 1000 * sh + 500 * vs'
           ' + 2 * greatest(0::HUGEINT, ps::HUGEINT - 1000 * n)', '100 * n')} AS pr,
    {cents('ps', '100 * pc')} AS ap
  FROM g
)
SELECT caregiverId, caregiver_name, email, phoneNumber, status, n AS total_commented_visits,
  {dbl('av', 'avg_comment_length')}, mxl::DOUBLE AS max_comment_length, mnl::DOUBLE AS min_comment_length,
  chars::DOUBLE AS total_comment_chars, vl AS very_long_comments, lo AS long_comments, me AS medium_comments,
  sh AS short_comments, vs AS very_short_comments, {dbl('dp', 'detailed_comment_percentage')},
  {dbl('mp', 'medium_comment_percentage')}, {dbl('bp', 'brief_comment_percentage')},
  {dbl('sc', 'avg_comment_detail_score')}, {dbl('cs', 'comment_consistency_score')},
  {dbl('pr', 'comment_professionalism_score')}, {dbl(hrs('us', 'n'), 'avg_visit_duration_hours')},
  {dbl(hrs('mxu'), 'max_visit_duration_hours')}, {dbl(hrs('mnu'), 'min_visit_duration_hours')},
  {dbl('ap', 'avg_chars_per_hour')}, {dbl('mxp', 'max_chars_per_hour')}, overnight_comments, weekend_comments,
  first_comment_date, last_comment_date, comment_active_days,
  CASE WHEN dp >= 7000 AND av >= 10000 THEN 'HIGHLY_DETAILED_DOCUMENTER' WHEN dp >= 5000 AND av >= 7500 THEN 'DETAILED_DOCUMENTER'
    WHEN dp >= 3000 AND av >= 5000 THEN 'REGULAR_DOCUMENTER' WHEN av >= 10000 THEN 'LONG_COMMENT_SPECIALIST'
    WHEN dp >= 5000 THEN 'FREQUENT_COMMENTER' ELSE 'OCCASIONAL_COMMENTER' END AS documentation_pattern,
  CASE WHEN sc >= 400 AND cs >= 300 THEN 'EXCELLENT' WHEN sc >= 300 AND cs >= 200 THEN 'GOOD'
    WHEN sc >= 200 AND cs >= 100 THEN 'AVERAGE' WHEN sc >= 100 THEN 'POOR' ELSE 'VERY_POOR' END AS comment_quality_rating,
  CASE WHEN ap >= 5000 THEN 'VERY_EFFICIENT' WHEN ap >= 3000 THEN 'EFFICIENT' WHEN ap >= 1500 THEN 'MODERATE'
    WHEN ap >= 500 THEN 'SLOW' ELSE 'VERY_SLOW' END AS comment_efficiency_rating,
  CASE WHEN dp >= 7000 AND av >= 10000 THEN 'Consistently provides detailed documentation in ' || {two('dp')} || '% of visits with average length of ' || {_A0}
    WHEN dp >= 5000 AND av >= 7500 THEN 'Frequently provides detailed documentation in ' || {two('dp')} || '% of visits with average length of ' || {_A0}
    WHEN dp >= 3000 AND av >= 5000 THEN 'Regularly provides documentation in ' || {two('dp')} || '% of visits with average length of ' || {_A0}
    WHEN av >= 10000 THEN 'Specializes in long comments with average length of ' || {_A0}
    WHEN dp >= 5000 THEN 'Frequently comments but with moderate detail, average length of ' || {_A0}
    ELSE 'Occasional commenter with average length of ' || {_A0} END AS insight_description
FROM r ORDER BY pr DESC, av DESC, dp DESC, caregiverId LIMIT 50"""

_RISK = "(4 * sp + 50 * sc + 2000 * greatest(0, suspicious_records - 5) + CASE WHEN mx >= 8 THEN 10000 ELSE 0 END)"
DOC_SUSPICION = f"""WITH {CAREGIVER}, {CARELOG}, {_ANOMALIES}, g AS (
  SELECT c.caregiverId, {WHO}, c.status, count(*) AS total_documented_visits,
    {n("anomaly_type <> 'NORMAL_DOCUMENTATION'")} AS suspicious_records,
    {n("anomaly_type = 'MISSING_DOCUMENTATION'")} AS missing_docs,
    {n("anomaly_type = 'VERY_SHORT_DOCUMENTATION'")} AS very_short_docs,
    {n("anomaly_type = 'SHORT_DOCUMENTATION'")} AS short_docs,
    {n("anomaly_type = 'EXCESSIVELY_LONG'")} AS excessively_long_docs,
    {n("anomaly_type = 'GENERIC_COMMENT'")} AS generic_comments,
    {n("anomaly_type = 'LENGTH_MISMATCH'")} AS length_mismatches,
    {n("anomaly_type = 'SUSPECTED_COPY_PASTE'")} AS copy_paste_suspected,
    {n("anomaly_type = 'DUPLICATE_CONTENT_SUSPECTED'")} AS duplicate_suspected,
    {n("anomaly_type = 'TOO_GENERIC'")} AS too_generic, sum(suspicion_score) AS ss, max(suspicion_score) AS mx,
    min(visit_date) AS first_doc_date, max(visit_date) AS last_doc_date, count(DISTINCT visit_date) AS doc_active_days
  FROM caregiver c JOIN anomalies v ON c.caregiverId = v.caregiverId
  GROUP BY c.caregiverId, c.firstName, c.lastName, c.email, c.phoneNumber, c.status HAVING count(*) >= 3
), r AS (
  SELECT *, {rate('suspicious_records', 'total_documented_visits')} AS sp, {rate('missing_docs', 'total_documented_visits')} AS ms,
    {rate('very_short_docs + short_docs', 'total_documented_visits')} AS sh, {rate('generic_comments', 'total_documented_visits')} AS ge,
    {cents('ss', 'total_documented_visits')} AS sc FROM g
), x AS (SELECT *, {_RISK} AS raw FROM r)
SELECT * EXCLUDE (ss, mx, sp, ms, sh, ge, sc, raw), {dbl('sp', 'suspicious_percentage')}, {dbl('ms', 'missing_percentage')},
  {dbl('sh', 'short_percentage')}, {dbl('ge', 'generic_percentage')}, {dbl('sc', 'avg_suspicion_score')},
  mx::DOUBLE AS max_suspicion_score,
  CASE WHEN sp >= 8000 THEN 'HIGHLY_SUSPICIOUS' WHEN sp >= 6000 THEN 'VERY_SUSPICIOUS' WHEN sp >= 4000 THEN 'SUSPICIOUS'
    WHEN sp >= 2000 THEN 'MODERATELY_SUSPICIOUS' WHEN sp >= 1000 THEN 'SLIGHTLY_SUSPICIOUS' ELSE 'NORMAL' END AS suspicion_level,
  CASE WHEN ms >= 5000 THEN 'FREQUENT_MISSING_DOCS' WHEN sh >= 6000 THEN 'FREQUENT_SHORT_DOCS'
    WHEN ge >= 4000 THEN 'FREQUENT_GENERIC_COMMENTS' WHEN copy_paste_suspected > 0 THEN 'COPY_PASTE_DETECTED'
    WHEN duplicate_suspected > 0 THEN 'DUPLICATE_CONTENT_DETECTED' WHEN length_mismatches > 0 THEN 'LENGTH_MISMATCH_DETECTED'
    WHEN excessively_long_docs > 0 THEN 'EXCESSIVELY_LONG_DOCS' ELSE 'MINOR_ISSUES' END AS primary_issue_type,
  {dbl('((raw + 5) // 10)', 'suspicion_risk_score')},
  CASE WHEN raw >= 80000 THEN 'IMMEDIATE_INVESTIGATION_REQUIRED' WHEN raw >= 60000 THEN 'DETAILED_REVIEW_NEEDED'
    WHEN raw >= 40000 THEN 'MONITOR_CLOSELY' WHEN raw >= 20000 THEN 'PERIODIC_REVIEW' ELSE 'NORMAL_MONITORING' END AS recommended_action,
  CASE WHEN sp >= 8000 THEN 'Highly suspicious documentation patterns with ' || {two('sp')} || '% of records showing issues'
    WHEN sp >= 6000 THEN 'Very suspicious documentation patterns with ' || {two('sp')} || '% of records showing issues'
    WHEN sp >= 4000 THEN 'Suspicious documentation patterns with ' || {two('sp')} || '% of records showing issues'
    WHEN ms >= 5000 THEN 'Frequently missing documentation in ' || {two('ms')} || '% of visits'
    WHEN sh >= 6000 THEN 'Frequently provides very short documentation in ' || {two('sh')} || '% of visits'
    WHEN ge >= 4000 THEN 'Frequently uses generic comments in ' || {two('ge')} || '% of visits'
    WHEN copy_paste_suspected > 0 THEN 'Suspected copy-paste behavior detected in documentation'
    WHEN duplicate_suspected > 0 THEN 'Suspected duplicate content in documentation'
    ELSE 'Minor documentation issues detected' END AS insight_description
FROM x ORDER BY raw DESC, sp DESC, suspicious_records DESC, caregiverId LIMIT 50"""

_OT_AGG = f"""count(*) AS total_visits, {n('overtime_us > 0')} AS overtime_visits, {n('overtime_us = 0')} AS on_time_visits,
    {hrs("sum(overtime_us) FILTER (WHERE overtime_us > 0)", n('overtime_us > 0'))} AS av, {hrs('max(overtime_us)')} AS mx,
    {hrs('sum(overtime_us)')} AS tt,
    {cents("sum(overtime_percentage_h) FILTER (WHERE overtime_percentage_h > 0)", f"100 * {n('overtime_percentage_h > 0')}")} AS ap,
    {rate(n('overtime_us > 0'), 'count(*)')} AS f, {rate(n(f'overtime_us > 2 * {HOUR}'), 'count(*)')} AS se,
    {rate(n(f'overtime_us > 4 * {HOUR}'), 'count(*)')} AS ex,
    min(visit_date) AS first_visit_date, max(visit_date) AS last_visit_date, count(DISTINCT visit_date) AS active_days"""
_OT_GROUP = """FROM caregiver c JOIN worked v ON c.caregiverId = v.caregiverId
  GROUP BY c.caregiverId, c.firstName, c.lastName, c.email, c.phoneNumber, c.status HAVING count(*) >= 5"""

OVERTIME = f"""WITH {CAREGIVER}, {CARELOG_TIMES}, {_OVERTIME}, g AS (
  SELECT c.caregiverId, {WHO}, c.status, {_OT_AGG},
    {hrs('sum(scheduled_us)', 'count(*)')} AS sh, {hrs('sum(actual_us)', 'count(*)')} AS ah,
    {hrs('sum(actual_us - scheduled_us)', 'count(*)')} AS dh, max(overtime_percentage_h) AS mp,
    count(DISTINCT date_trunc('month', visit_date)) AS active_months,
    max(visit_date) FILTER (WHERE overtime_us > 0) AS last_overtime_date
  {_OT_GROUP}
), r AS (
  SELECT *, (4 * f + 200 * greatest(0, av - 100) + 3 * se + 20 * greatest(0, mx - 400) + 5) // 10 AS rs
  FROM g WHERE overtime_visits > 0
)
SELECT caregiverId, caregiver_name, email, phoneNumber, status, total_visits, overtime_visits, on_time_visits,
  {dbl('sh', 'avg_scheduled_hours')}, {dbl('ah', 'avg_actual_hours')}, {dbl('dh', 'avg_hours_difference')},
  {dbl('av', 'avg_overtime_hours')}, {dbl('mx', 'max_overtime_hours')}, {dbl('tt', 'total_overtime_hours')},
  {dbl('f', 'overtime_frequency_percentage')}, {dbl('se', 'severe_overtime_frequency')}, {dbl('ex', 'extreme_overtime_frequency')},
  {dbl('ap', 'avg_overtime_percentage')}, {dbl('mp', 'max_overtime_percentage')},
  first_visit_date, last_visit_date, active_days, active_months, last_overtime_date,
  CASE WHEN f >= 5000 AND av >= 200 THEN 'CRITICAL' WHEN f >= 3000 AND av >= 150 THEN 'HIGH'
    WHEN f >= 2000 AND av >= 100 THEN 'MEDIUM' WHEN f >= 1000 THEN 'LOW' ELSE 'MINIMAL' END AS overtime_severity,
  CASE WHEN f >= 5000 THEN 'FREQUENT_OVERTIME' WHEN se >= 2000 THEN 'SEVERE_OVERTIME' WHEN ex >= 1000 THEN 'EXTREME_OVERTIME'
    WHEN av >= 200 THEN 'LONG_OVERTIME' WHEN f >= 2000 THEN 'MODERATE_OVERTIME' ELSE 'OCCASIONAL_OVERTIME' END AS overtime_pattern,
  {dbl('rs', 'overtime_risk_score')}
FROM r ORDER BY rs DESC NULLS FIRST, f DESC NULLS FIRST, tt DESC NULLS FIRST, caregiverId LIMIT 50"""

_WE = "day_type = 'WEEKEND'"
OVERTIME_INSIGHT = f"""WITH {CAREGIVER}, {CARELOG_TIMES}, {_OVERTIME}, g AS (
  SELECT c.caregiverId, {WHO}, c.status, {_OT_AGG}, {n(_WE)} AS weekend_visits,
    {n(f'{_WE} AND overtime_us > 0')} AS weekend_overtime, {rate(n(f'{_WE} AND overtime_us > 0'), n(_WE))} AS wr,
    {n("shift_type = 'EXTENDED_SHIFT'")} AS extended_shifts, {n("shift_type = 'LONG_SHIFT'")} AS long_shifts,
    {n("shift_type = 'NORMAL_SHIFT'")} AS normal_shifts, {n("shift_type = 'SHORT_SHIFT'")} AS short_shifts,
    {n("time_period = 'EARLY_MORNING' AND overtime_us > 0")} AS early_morning_overtime,
    {n("time_period = 'EVENING' AND overtime_us > 0")} AS evening_overtime,
    {n("time_period = 'NIGHT' AND overtime_us > 0")} AS night_overtime,
    count(DISTINCT visit_month) AS active_months
  {_OT_GROUP}
), r AS (
  SELECT *, 3 * f + 150 * greatest(0, av - 100) + 4 * se + 2 * wr + 30 * greatest(0, mx - 400) AS raw,
    CASE WHEN f >= 6000 AND av >= 200 THEN 'CHRONIC_OVERTIME_WORKER' WHEN f >= 4000 AND av >= 150 THEN 'FREQUENT_OVERTIME_WORKER'
      WHEN se >= 3000 THEN 'SEVERE_OVERTIME_PATTERN' WHEN wr >= 5000 THEN 'WEEKEND_OVERTIME_SPECIALIST'
      WHEN extended_shifts > 0 AND 5 * extended_shifts >= total_visits THEN 'EXTENDED_SHIFT_WORKER'
      WHEN evening_overtime > 0 AND 2 * evening_overtime >= overtime_visits THEN 'EVENING_OVERTIME_PATTERN'
      WHEN night_overtime > 0 AND 10 * night_overtime >= 3 * overtime_visits THEN 'NIGHT_OVERTIME_PATTERN'
      WHEN f >= 2000 THEN 'MODERATE_OVERTIME_WORKER' ELSE 'OCCASIONAL_OVERTIME_WORKER' END AS overtime_pattern_type
  FROM g WHERE overtime_visits > 0
)
SELECT caregiverId, caregiver_name, email, phoneNumber, status, total_visits, overtime_visits, on_time_visits,
  {dbl('av', 'avg_overtime_hours')}, {dbl('mx', 'max_overtime_hours')}, {dbl('tt', 'total_overtime_hours')},
  {dbl('ap', 'avg_overtime_percentage')}, {dbl('f', 'overtime_frequency')}, {dbl('se', 'severe_overtime_frequency')},
  {dbl('ex', 'extreme_overtime_frequency')}, weekend_visits, weekend_overtime, {dbl('wr', 'weekend_overtime_rate')},
  extended_shifts, long_shifts, normal_shifts, short_shifts, early_morning_overtime, evening_overtime, night_overtime,
  first_visit_date, last_visit_date, active_days, active_months, overtime_pattern_type,
  CASE WHEN raw >= 80000 THEN 'CRITICAL_RISK' WHEN raw >= 60000 THEN 'HIGH_RISK' WHEN raw >= 40000 THEN 'MODERATE_RISK'
    WHEN raw >= 20000 THEN 'LOW_RISK' ELSE 'MINIMAL_RISK' END AS risk_level,
  CASE WHEN raw >= 80000 THEN 'IMMEDIATE_INTERVENTION_REQUIRED' WHEN raw >= 60000 THEN 'SCHEDULE_ADJUSTMENT_NEEDED'
    WHEN raw >= 40000 THEN 'MONITOR_CLOSELY' WHEN raw >= 20000 THEN 'PERIODIC_REVIEW' ELSE 'NORMAL_MONITORING' END AS recommended_action,
  {dbl('((raw + 5) // 10)', 'overtime_risk_score')},
  CASE overtime_pattern_type
    WHEN 'CHRONIC_OVERTIME_WORKER' THEN 'Chronic overtime worker with ' || {two('f')} || '% overtime frequency and average ' || printf('%.1f', ((av + 5) // 10) / 10.0) || ' hours overtime per shift'
    WHEN 'FREQUENT_OVERTIME_WORKER' THEN 'Frequent overtime worker with ' || {two('f')} || '% overtime frequency'
    WHEN 'SEVERE_OVERTIME_PATTERN' THEN 'Shows severe overtime pattern with ' || {two('se')} || '% of shifts exceeding 2 hours overtime'
    WHEN 'WEEKEND_OVERTIME_SPECIALIST' THEN 'Specializes in weekend overtime with ' || {two('wr')} || '% weekend overtime rate'
    WHEN 'EXTENDED_SHIFT_WORKER' THEN 'Frequently works extended shifts (>12 hours) with ' || CAST(extended_shifts AS VARCHAR) || ' extended shifts'
    WHEN 'EVENING_OVERTIME_PATTERN' THEN 'Shows evening overtime pattern with ' || CAST(evening_overtime AS VARCHAR) || ' evening overtime shifts'
    WHEN 'NIGHT_OVERTIME_PATTERN' THEN 'Shows night overtime pattern with ' || CAST(night_overtime AS VARCHAR) || ' night overtime shifts'
    WHEN 'MODERATE_OVERTIME_WORKER' THEN 'Moderate overtime worker with ' || {two('f')} || '% overtime frequency'
    ELSE 'Occasional overtime worker with ' || {two('f')} || '% overtime frequency' END AS pattern_insight,
  CASE WHEN wr > 5000 THEN 'High weekend overtime rate suggests potential scheduling issues or weekend staffing shortages'
    WHEN se > 3000 THEN 'High severe overtime frequency indicates potential workload management issues'
    WHEN 10 * evening_overtime > 6 * overtime_visits THEN 'Evening overtime pattern suggests potential shift handover or evening workload issues'
    WHEN 10 * night_overtime > 4 * overtime_visits THEN 'Night overtime pattern suggests potential overnight care requirements'
    WHEN 10 * extended_shifts > 3 * total_visits THEN 'High number of extended shifts suggests potential staffing shortages or complex care needs'
    WHEN av > 300 THEN 'High average overtime hours suggests potential workload or scheduling inefficiencies'
    ELSE 'Standard overtime patterns observed' END AS key_insight
FROM r ORDER BY raw IS NULL DESC, (raw + 5) // 10 DESC, f DESC, tt DESC, caregiverId LIMIT 100"""

STATEMENTS = {
    "visit_facts": VISIT_FACTS,
    "duration_flags": DURATION_FLAGS,
    "comment_categories": COMMENT_CATEGORIES,
    "doc_anomalies": DOC_ANOMALIES,
    "duration_stats": DURATION_STATS,
    "overtime_rows": OVERTIME_ROWS,
    "report_reliability": RELIABILITY,
    "report_visit_duration": VISIT_DURATION,
    "report_comment_detail": COMMENT_DETAIL,
    "report_doc_suspicion": DOC_SUSPICION,
    "report_top_performance": TOP_PERFORMANCE,
    "report_abnormal_visits": ABNORMAL,
    "report_overtime_insight": OVERTIME_INSIGHT,
    "report_overtime": OVERTIME,
}
# the same reports without their limit
STATEMENTS |= {f"{name}_all": re.sub(r"\s+LIMIT \d+\s*$", "", text) for name, text in STATEMENTS.items() if name.startswith("report_")}
# and over figures kept per load; abnormal visits are not kept so
STATEMENTS |= {
    name.removesuffix("_all") + "_merged": text
    for name, text in STATEMENTS.items()
    if name.endswith("_all") and "abnormal" not in name
}

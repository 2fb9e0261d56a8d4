"""Quarantine and rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.catalog.base import LAYOUT, MEASURES, WIDE_DOUBLES, Tables, query
from daymark.functions.storage import scratch_path
from daymark.operators import quality, quarantine

_NUMBERS = ["latitude", "longitude", *MEASURES]
_REQUIRED = ["date", "location", "latitude", "longitude", "source", *MEASURES]


def _code(condition: str, code: str) -> str:
    return f"CASE WHEN {condition} THEN '{code}' END"


def _codes_sql() -> str:
    """Ordered reason codes of a row, joined with a bar; '' when there is none."""
    parts = [_code("d IS NULL", "INVALID_DATE"),
             _code(" OR ".join(f"{c} IS NULL" for c in _REQUIRED), "MISSING_REQUIRED"),
             _code("TRIM(location) = ''", "EMPTY_LOCATION"),
             _code("TRIM(source) = ''", "EMPTY_SOURCE")]
    for c in _NUMBERS:
        label = c.upper() if c in MEASURES else c
        parts.append(_code(f"n_{c} IS NULL OR NOT ISFINITE(n_{c})", f"INVALID_NUMERIC_{label}"))
        if c in MEASURES:
            parts.append(_code(f"n_{c} = -999", f"PROVIDER_FILL_{label}"))
    parts += [_code("COALESCE(NOT n_latitude BETWEEN -90 AND 90, true)", "LATITUDE_RANGE"),
              _code("COALESCE(NOT n_longitude BETWEEN -180 AND 180, true)", "LONGITUDE_RANGE"),
              _code("COALESCE(NOT n_rh2m BETWEEN 0 AND 100, true)", "HUMIDITY_RANGE")]
    parts += [_code(f"n_{c} < 0", f"NEGATIVE_{c.upper()}")
              for c in ("prectotcorr", "ws2m", "allsky_sfc_sw_dwn")]
    parts += [_code("n_t2m_min > n_t2m OR n_t2m > n_t2m_max", "TEMPERATURE_ORDER"),
              _code("source IS DISTINCT FROM 'PROVIDER_A'", "UNSUPPORTED_SOURCE"),
              _code("copies > 1", "DUPLICATE_KEY")]
    return f"CONCAT_WS('|', {', '.join(parts)})"


CODED = f"""typed AS (SELECT *, CAST(TRY_STRPTIME(date, '%Y-%m-%d') AS DATE) AS d,
 {', '.join(f'TRY_CAST({c} AS DOUBLE) AS n_{c}' for c in _NUMBERS)} FROM r1),
counted AS (SELECT *, COUNT(*) OVER (PARTITION BY location, d, source) AS copies FROM typed),
coded AS (SELECT *, {_codes_sql()} AS codes FROM counted)"""


def coded(t: Tables):
    return quarantine.quarantine_codes(t.r1, LAYOUT)


@query("quarantine_codes", f"WITH {CODED} SELECT row_number, codes FROM coded")
def _(t: Tables):
    return coded(t).select("row_number", F.col("reason_codes").alias("codes"))


@query("quarantine_accepted",
       f"WITH {CODED} SELECT d AS date, location, n_latitude AS latitude, "
       "n_longitude AS longitude, source, "
       + ", ".join(f"n_{m} AS {m}" for m in MEASURES) + " FROM coded WHERE codes = ''",
       WIDE_DOUBLES)
def _(t: Tables):
    return quarantine.accepted_rows(coded(t), LAYOUT)


@query("quarantine_rejected",
       f"WITH {CODED} SELECT row_number AS input_row_number, {', '.join(_REQUIRED)}, "
       "codes AS reason_codes FROM coded WHERE codes <> ''")
def _(t: Tables):
    return quarantine.rejected_rows(coded(t), "row_number", LAYOUT)


@query("quarantine_reason_counts",
       f"WITH {CODED} SELECT code, COUNT(*) AS rows FROM (SELECT UNNEST(STRING_SPLIT(codes, '|')) "
       "AS code FROM coded WHERE codes <> '') GROUP BY code")
def _(t: Tables):
    return quarantine.reason_counts(coded(t))


_ACCOUNTING = """SELECT COUNT(*) AS rows_read, COUNT(*) FILTER (codes = '') AS rows_loaded,
 COUNT(*) FILTER (codes <> '') AS rows_rejected FROM coded"""


@query("quarantine_accounting", f"WITH {CODED} {_ACCOUNTING}")
def _(t: Tables):
    return quarantine.accounting(coded(t))


@query("quality_gate",
       f"""WITH {CODED}, acc AS ({_ACCOUNTING}) SELECT *,
 CASE WHEN rows_rejected > 0 THEN 'FAIL' ELSE 'PASS' END AS overall_status,
 CASE WHEN rows_rejected > 0 THEN 'rows were rejected; downstream refresh is blocked' END
 AS reason FROM acc""")
def _(t: Tables):
    return quarantine.quality_gate(quarantine.accounting(coded(t)))


@query("quality_gate_with_rules",
       f"""WITH {CODED}, acc AS ({_ACCOUNTING}), clean AS (SELECT rows_loaded AS rows_read, rows_loaded,
 CAST(0 AS BIGINT) AS rows_rejected FROM acc)
SELECT 'rejected' AS pair, *, 'FAIL' AS overall_status,
 'rows were rejected; downstream refresh is blocked' AS reason FROM acc
UNION ALL SELECT 'rules fail', *, 'FAIL', NULL FROM clean UNION ALL SELECT 'clean', *, 'PASS', NULL FROM clean""")
def _(t: Tables):
    """Rejected rows block whatever the rules say; without them the rules decide."""
    counts = quarantine.accounting(coded(t))
    clean = counts.select(F.col("rows_loaded").alias("rows_read"), "rows_loaded",
                          F.lit(0).cast("long").alias("rows_rejected"))
    passed, failed = quality.quality_overall(t.w3, LAYOUT), quality.quality_overall(t.d1, LAYOUT)
    parts = [quarantine.quality_gate(c, o).withColumn("pair", F.lit(n)) for n, c, o in (
        ("rejected", counts, passed), ("rules fail", clean, failed), ("clean", clean, passed))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("quarantine_write",
       f"""WITH {CODED}, acc AS ({_ACCOUNTING}) SELECT rows_rejected AS rejected_rows_written,
 *, true AS ok FROM acc""")
def _(t: Tables):
    return quarantine.quarantine_write(coded(t), scratch_path(t.spark, "quarantine"),
                                       "row_number", LAYOUT)


# ---------------------------------------------------------------- rules

def _rule_sql(rule: quality.Rule, affected: str) -> str:
    bad = "WARNING" if rule.severity == "WARNING" else "FAIL"
    return (f"SELECT '{rule.name}' AS rule_name, '{rule.category}' AS category, "
            f"'{rule.severity}' AS severity, CASE WHEN n = 0 THEN 'PASS' ELSE '{bad}' END "
            f"AS status, n AS affected_rows, '{rule.description}' AS description "
            f"FROM (SELECT CAST(COALESCE(({affected}), 0) AS BIGINT) AS n)")


def _count(condition: str) -> str:
    return f"SELECT COUNT(*) FROM base WHERE {condition}"


_AFFECTED = {
    quality.MISSING: "SELECT SUM(" + " + ".join(
        f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in _REQUIRED) + ") FROM base",
    quality.DUPLICATES: "SELECT SUM(c) FROM (SELECT COUNT(*) AS c FROM base "
                        "GROUP BY location, date) WHERE c > 1",
    quality.COORDINATES: _count("COALESCE(NOT latitude BETWEEN -90 AND 90, true) OR "
                                "COALESCE(NOT longitude BETWEEN -180 AND 180, true)"),
    quality.HUMIDITY: _count("COALESCE(NOT rh2m BETWEEN 0 AND 100, true)"),
    quality.RAIN: _count("prectotcorr < 0"), quality.WIND: _count("ws2m < 0"),
    quality.SOLAR: _count("allsky_sfc_sw_dwn < 0"),
    quality.TEMPERATURE: _count("t2m_min > t2m OR t2m > t2m_max OR t2m_min > t2m_max"),
    quality.COVERAGE: "SELECT SUM(DATE_DIFF('day', lo, hi) + 1 - n) FROM (SELECT MIN(date) AS lo, "
                      "MAX(date) AS hi, COUNT(DISTINCT date) AS n FROM base "
                      "WHERE location IS NOT NULL GROUP BY location)",
    quality.SOURCE: _count("source IS DISTINCT FROM 'PROVIDER_A'")}
RULES = {r: _rule_sql(r, a) for r, a in _AFFECTED.items()}
DIRTY = "WITH base AS (SELECT * FROM d1)"


def _register_rule(name: str, check, *rules: quality.Rule) -> None:
    query(name, f"{DIRTY} " + " UNION ALL ".join(RULES[r] for r in rules))(
        lambda t: check(t.d1, LAYOUT))


_register_rule("qc_missing_values", quality.check_missing_values, quality.MISSING)
_register_rule("qc_duplicate_location_date", quality.check_duplicates, quality.DUPLICATES)
_register_rule("qc_coordinates", quality.check_coordinates, quality.COORDINATES)
_register_rule("qc_humidity", quality.check_humidity, quality.HUMIDITY)
_register_rule("qc_non_negative", quality.check_non_negative, quality.RAIN, quality.WIND,
               quality.SOLAR)
_register_rule("qc_temperature_order", quality.check_temperature_order, quality.TEMPERATURE)
_register_rule("qc_daily_coverage", quality.check_daily_coverage, quality.COVERAGE)
_register_rule("qc_source", quality.check_source, quality.SOURCE)

LONG = "lg AS (" + " UNION ALL ".join(
    f"SELECT '{m.upper()}' AS variable_code, {m} AS value FROM base" for m in MEASURES) + ")"
BOUNDS = f"""{LONG}, bounds AS (SELECT variable_code, q1, q3, q3 - q1 AS iqr,
 q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM (
 SELECT variable_code, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
 FROM lg WHERE value IS NOT NULL GROUP BY variable_code)),
flags AS (SELECT b.*, COUNT(*) FILTER (value < lower_bound OR value > upper_bound)
 AS outlier_count, COUNT(value) AS n FROM lg JOIN bounds b USING (variable_code) GROUP BY ALL)"""
BOUND_DOUBLES = "q1 q3 iqr lower_bound upper_bound"
CLEAN = "WITH base AS (SELECT * FROM w2)"


@query("qc_iqr_bounds", f"{CLEAN}, {BOUNDS} SELECT * FROM bounds", BOUND_DOUBLES)
def _(t: Tables):
    return quality.iqr_bounds(t.w2, LAYOUT)


@query("qc_iqr_flags",
       f"{CLEAN}, {BOUNDS} SELECT *, CASE WHEN n > 0 THEN outlier_count * 100.0 / n ELSE 0 END "
       "AS outlier_percent FROM flags", BOUND_DOUBLES + " outlier_percent")
def _(t: Tables):
    return quality.iqr_flags(t.w2, LAYOUT)


BASELINE = quality.Baseline(rows=1000, locations=2, dates=2499, start_date="1995-01-02",
                            end_date="2001-11-04")
_BASELINE_ROWS = [("baseline_row_count", "COUNT(*)", BASELINE.rows),
                  ("baseline_location_count", "COUNT(DISTINCT location)", BASELINE.locations),
                  ("baseline_date_count", "COUNT(DISTINCT date)", BASELINE.dates),
                  ("baseline_start_date", "MIN(date)", BASELINE.start_date),
                  ("baseline_end_date", "MAX(date)", BASELINE.end_date)]
BASELINE_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS rule_name, 'baseline' AS category, 'ERROR' AS severity, "
    f"CASE WHEN v = '{e}' THEN 'PASS' ELSE 'FAIL' END AS status, "
    f"CAST(CASE WHEN v = '{e}' THEN 0 ELSE 1 END AS BIGINT) AS affected_rows, "
    f"CONCAT('Expected {e}; observed ', v, '.') AS description "
    f"FROM (SELECT CAST({x} AS VARCHAR) AS v FROM base)" for n, x, e in _BASELINE_ROWS)


@query("qc_baseline", f"WITH base AS (SELECT * FROM w1) {BASELINE_SQL}")
def _(t: Tables):
    return quality.check_baseline(t.w1, BASELINE, LAYOUT)


_IQR_RULES = """SELECT 'iqr_flag_' || variable_code AS rule_name,
 'statistical_diagnostic' AS category, 'WARNING' AS severity,
 CASE WHEN outlier_count = 0 THEN 'PASS' ELSE 'WARNING' END AS status,
 outlier_count AS affected_rows, variable_code || ' values beyond 1.5 interquartile ranges; unusual, not necessarily wrong.'
 AS description FROM flags"""
SUMMARY = (f"SELECT 'required_columns_present' AS rule_name, 'schema' AS category, "
           f"'ERROR' AS severity, 'PASS' AS status, CAST(0 AS BIGINT) AS affected_rows, "
           f"'{quality.COLUMNS.description}' AS description UNION ALL "
           + " UNION ALL ".join(RULES[r] for r in quality.ROW_RULES)
           + f" UNION ALL {_IQR_RULES} UNION ALL {BASELINE_SQL}")


@query("qc_summary", f"{DIRTY}, {BOUNDS} {SUMMARY}")
def _(t: Tables):
    return quality.quality_summary(t.d1, LAYOUT, BASELINE)


@query("qc_overall",
       f"""{CLEAN}, {BOUNDS}, summary AS ({SUMMARY.rsplit(' UNION ALL ' + BASELINE_SQL, 1)[0]})
SELECT CASE WHEN MAX(CASE WHEN severity = 'ERROR' AND status = 'FAIL' THEN 1 ELSE 0 END) = 1
 THEN 'FAIL' ELSE 'PASS' END AS overall_status,
 COUNT(*) FILTER (severity = 'ERROR' AND status = 'FAIL') AS error_failures,
 COUNT(*) FILTER (status = 'WARNING') AS warning_rules,
 CAST(SUM(CASE WHEN rule_name LIKE 'iqr%' THEN affected_rows ELSE 0 END) AS BIGINT)
 AS total_iqr_flags, (SELECT COUNT(*) FROM base) AS rows,
 (SELECT COUNT(DISTINCT location) FROM base) AS locations,
 (SELECT COUNT(DISTINCT date) FROM base) AS dates, (SELECT MIN(date) FROM base) AS start_date,
 (SELECT MAX(date) FROM base) AS end_date, (SELECT COUNT(DISTINCT source) FROM base) AS sources
FROM summary""")
def _(t: Tables):
    return quality.quality_overall(t.w2, LAYOUT)

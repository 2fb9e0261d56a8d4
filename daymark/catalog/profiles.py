"""Profiling queries over the sparse, the continuous and the damaged table."""

from __future__ import annotations

from daymark.catalog.base import MEASURES, WIDE_DOUBLES, LAYOUT, Tables, query
from daymark.catalog.plain import GAPS_SQL
from daymark.catalog.quality import BOUNDS, CLEAN
from daymark.operators import profiling

COLUMNS = ["date", "location", "latitude", "longitude", "source", *MEASURES]
_TYPES = {"date": "date", "location": "string", "source": "string"}
LONG = "lg AS (" + " UNION ALL ".join(
    f"SELECT location, date, '{m.upper()}' AS variable_code, {m} AS value FROM base"
    for m in MEASURES) + ")"
DIRTY = "WITH base AS (SELECT * FROM d1)"


def _each(template: str, columns=COLUMNS) -> str:
    return " UNION ALL ".join(template.format(c=c, t=_TYPES.get(c, "double"), u=c.upper())
                              for c in columns)


@query("profile_schema", f"{DIRTY} " + _each(
    "SELECT '{c}' AS \"column\", '{t}' AS dtype, COUNT({c}) AS non_null, "
    "COUNT(*) - COUNT({c}) AS \"null\", COUNT(DISTINCT {c}) AS \"unique\" FROM base"))
def _(t: Tables):
    return profiling.profile_schema(t.d1)


@query("profile_invalid_dates",
       "SELECT COUNT(*) FILTER (TRY_STRPTIME(date, '%Y-%m-%d') IS NULL) AS invalid_dates FROM r1")
def _(t: Tables):
    return profiling.profile_invalid_dates(t.r1, LAYOUT)


@query("profile_temporal_coverage",
       "SELECT location, MIN(date) AS min_date, MAX(date) AS max_date, COUNT(date) AS observations "
       "FROM w2 GROUP BY location")
def _(t: Tables):
    return profiling.profile_temporal_coverage(t.w2)


@query("profile_points", "SELECT DISTINCT location, latitude, longitude FROM d1",
       "latitude longitude")
def _(t: Tables):
    return profiling.profile_points(t.d1)


@query("profile_coordinate_variants",
       "SELECT location, COUNT(DISTINCT latitude) AS latitude_count, "
       "COUNT(DISTINCT longitude) AS longitude_count FROM d1 GROUP BY location")
def _(t: Tables):
    return profiling.profile_coordinate_variants(t.d1)


@query("profile_describe",
       f"{DIRTY}, {LONG} SELECT variable_code, COUNT(value) AS count, AVG(value) AS mean, "
       "STDDEV_SAMP(value) AS std, MIN(value) AS min, quantile_cont(value, 0.25) AS p25, "
       "quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, MAX(value) AS max "
       "FROM lg GROUP BY variable_code", "mean std min p25 p50 p75 max")
def _(t: Tables):
    return profiling.profile_describe(t.d1, LAYOUT)


@query("profile_missing", f"{DIRTY} " + _each(
    "SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS missing_count, "
    "(COUNT(*) - COUNT({c})) * 100.0 / COUNT(*) AS missing_percent FROM base"), "missing_percent")
def _(t: Tables):
    return profiling.profile_missing(t.d1)


@query("profile_sentinels",
       f"{DIRTY}, {LONG} SELECT variable_code, CAST(value AS INTEGER) AS sentinel, "
       "COUNT(*) AS rows FROM lg WHERE value IN (-9999, -999, -99, 999, 9999) GROUP BY ALL")
def _(t: Tables):
    return profiling.profile_sentinels(t.d1, LAYOUT)


_DOUBLED = """base AS (SELECT * FROM d1 UNION ALL SELECT * FROM d1 WHERE rh2m = 50)"""


def doubled(t: Tables):
    from pyspark.sql import functions as F
    return t.d1.unionByName(t.d1.filter(F.col("rh2m") == 50))


@query("profile_exact_duplicates",
       f"WITH {_DOUBLED} SELECT CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS exact_duplicate_rows "
       f"FROM (SELECT COUNT(*) AS c FROM base GROUP BY {', '.join(COLUMNS)})")
def _(t: Tables):
    return profiling.profile_exact_duplicates(doubled(t))


_ORDER = ", ".join(f"{c} NULLS FIRST" for c in COLUMNS)


@query("profile_exact_duplicate_samples",
       f"WITH {_DOUBLED} SELECT {', '.join(COLUMNS)} FROM (SELECT *, COUNT(*) OVER (PARTITION BY "
       f"{', '.join(COLUMNS)}) AS c FROM base) WHERE c > 1 ORDER BY location NULLS FIRST, "
       f"date NULLS FIRST, {_ORDER} LIMIT 20", WIDE_DOUBLES)
def _(t: Tables):
    return profiling.sample_exact_duplicates(doubled(t), ["location", "date"])


@query("profile_key_duplicates",
       f"""{DIRTY}, k AS (SELECT *, COUNT(*) OVER (PARTITION BY location, date) AS c FROM base)
SELECT {', '.join(COLUMNS)}, (SELECT COUNT(*) FROM k WHERE c > 1) AS duplicate_rows FROM k
WHERE c > 1 ORDER BY location NULLS FIRST, date NULLS FIRST, {_ORDER} LIMIT 30""", WIDE_DOUBLES)
def _(t: Tables):
    return profiling.profile_key_duplicates(t.d1, tie=COLUMNS)


_GAPS = """SELECT location, MIN(date) AS start_date, MAX(date) AS end_date,
 COALESCE(DATE_DIFF('day', MIN(date), MAX(date)) + 1, 0) AS expected_days,
 COUNT(DISTINCT date) AS observed_unique_days,
 COALESCE(DATE_DIFF('day', MIN(date), MAX(date)) + 1, 0) - COUNT(DISTINCT date) AS missing_days
 FROM base WHERE location IS NOT NULL GROUP BY location"""


@query("profile_date_gaps", f"{DIRTY} {_GAPS}")
def _(t: Tables):
    return profiling.profile_date_gaps(t.d1)


@query("profile_missing_dates", GAPS_SQL)
def _(t: Tables):
    return profiling.profile_missing_dates(t.w2)


_RULES = {
    "temperature_consistency_violations": "t2m_min > t2m OR t2m > t2m_max",
    "invalid_relative_humidity": "rh2m < 0 OR rh2m > 100",
    "negative_precipitation": "prectotcorr < 0", "negative_wind_speed": "ws2m < 0",
    "negative_solar_radiation": "allsky_sfc_sw_dwn < 0",
    "invalid_coordinates": "latitude < -90 OR latitude > 90 OR longitude < -180 "
                           "OR longitude > 180"}


@query("profile_rule_violations", f"{DIRTY} " + " UNION ALL ".join(
    f"SELECT '{n}' AS rule, COUNT(*) FILTER ({c}) AS violations FROM base"
    for n, c in _RULES.items()))
def _(t: Tables):
    return profiling.profile_rule_violations(t.d1, LAYOUT)


@query("profile_location_counts", "SELECT location, COUNT(*) AS rows FROM w2 GROUP BY location")
def _(t: Tables):
    return profiling.profile_location_counts(t.w2)


@query("profile_annual_counts", "SELECT CAST(year(date) AS INTEGER) AS year, location, "
       "COUNT(*) AS rows FROM w2 WHERE location IS NOT NULL GROUP BY ALL")
def _(t: Tables):
    return profiling.profile_annual_counts(t.w2, LAYOUT)


def _histogram(measure: str, bins: int) -> str:
    return f"""SELECT '{measure}' AS measure, CAST(bin AS INTEGER) AS bin,
 low + bin * ((high - low) / {bins}.0) AS lower_edge,
 low + (bin + 1) * ((high - low) / {bins}.0) AS upper_edge, COALESCE(rows, 0) AS rows
FROM (SELECT MIN({measure}) AS low, MAX({measure}) AS high FROM w2),
 (SELECT UNNEST(generate_series(0, {bins - 1})) AS bin) LEFT JOIN (
 SELECT CAST(LEAST(FLOOR(({measure} - lo) * {bins}.0 / (hi - lo)), {bins - 1}) AS BIGINT) AS bin,
 COUNT(*) AS rows FROM w2, (SELECT MIN({measure}) AS lo, MAX({measure}) AS hi FROM w2)
 GROUP BY 1) USING (bin)"""


@query("profile_histogram", _histogram("t2m", 50) + " UNION ALL " + _histogram("prectotcorr", 80),
       "lower_edge upper_edge")
def _(t: Tables):
    from pyspark.sql import functions as F
    parts = [profiling.profile_histogram(t.w2, m, n).withColumn("measure", F.lit(m))
             for m, n in (("t2m", 50), ("prectotcorr", 80))]
    return parts[0].unionByName(parts[1])


_BASIC = {
    "rows": "SELECT COUNT(*) FROM base", "columns": "SELECT 12",
    "locations": "SELECT COUNT(DISTINCT location) FROM base",
    "invalid_dates": "SELECT COUNT(*) - COUNT(date) FROM base",
    "exact_duplicate_rows": "SELECT COALESCE(SUM(c - 1), 0) FROM (SELECT COUNT(*) AS c FROM base "
                            f"GROUP BY {', '.join(COLUMNS)})",
    "duplicate_location_date_rows": "SELECT COALESCE(SUM(c), 0) FROM (SELECT COUNT(*) AS c "
                                    "FROM base GROUP BY location, date) WHERE c > 1",
    "missing_days": f"SELECT SUM(missing_days) FROM ({_GAPS})",
    **{n: f"SELECT COUNT(*) FROM base WHERE {c}" for n, c in _RULES.items()},
    **{f"missing_{m}": f"SELECT COUNT(*) - COUNT({m}) FROM base" for m in MEASURES}}
_SECTION = {"rows": "dataset", "columns": "dataset", "locations": "dataset",
            "missing_days": "missing_days",
            **{f"missing_{m}": "missing_values" for m in MEASURES}}


@query("profile_quality_report", f"{DIRTY}, {LONG} " + " UNION ALL ".join(
    f"SELECT '{_SECTION.get(n, 'quality_checks')}' AS section, '{n}' AS metric, "
    f"CAST(({q}) AS BIGINT) AS value" for n, q in _BASIC.items())
    + " UNION ALL SELECT 'sentinel_values', CONCAT(variable_code, ':', CAST(value AS INTEGER)), "
      "COUNT(*) FROM lg WHERE value IN (-9999, -999, -99, 999, 9999) GROUP BY 1, 2"
    + f" UNION ALL SELECT 'missing_days_by_location', location, missing_days FROM ({_GAPS})")
def _(t: Tables):
    return profiling.profile_quality_report(t.d1, LAYOUT)


_PROBLEMS = [("Completeness", "Missing daily dates", "missing_days"),
             ("Uniqueness", "Duplicate location-date records", "duplicate_location_date_rows"),
             ("Consistency", "Invalid min/mean/max temperature ordering",
              "temperature_consistency_violations"),
             ("Validity", "Relative humidity outside 0-100%", "invalid_relative_humidity"),
             ("Validity", "Negative precipitation values", "negative_precipitation"),
             ("Validity", "Negative wind-speed values", "negative_wind_speed")]


@query("profile_candidate_problems", f"{DIRTY} " + " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, '{p}' AS problem, CAST(({_BASIC[n]}) AS BIGINT) AS count"
    for d, p, n in _PROBLEMS))
def _(t: Tables):
    return profiling.profile_candidate_problems(t.d1, LAYOUT)


@query("profile_bounding_box",
       "SELECT *, latitude_max - latitude_min AS latitude_span_degrees, "
       "longitude_max - longitude_min AS longitude_span_degrees FROM ("
       "SELECT COUNT(*) AS sampled_locations, MIN(latitude) AS latitude_min, "
       "MAX(latitude) AS latitude_max, MIN(longitude) AS longitude_min, "
       "MAX(longitude) AS longitude_max FROM (SELECT DISTINCT location, latitude, longitude "
       "FROM w2))", "latitude_min latitude_max longitude_min longitude_max "
                    "latitude_span_degrees longitude_span_degrees")
def _(t: Tables):
    return profiling.profile_bounding_box(t.w2)


def _quantiles(wanted: dict[str, float], value: str) -> str:
    return ", ".join(f"quantile_cont({value}, {p}) AS {n}" for n, p in wanted.items())


@query("profile_percentiles",
       f"{CLEAN}, {LONG} SELECT variable_code, "
       f"{_quantiles(profiling.TAIL_QUANTILES, 'value')} FROM lg GROUP BY variable_code",
       list(profiling.TAIL_QUANTILES))
def _(t: Tables):
    return profiling.profile_percentiles(t.w2, LAYOUT)


@query("profile_rain_percentiles",
       f"SELECT {_quantiles(profiling.RAIN_QUANTILES, 'prectotcorr')} FROM w2",
       list(profiling.RAIN_QUANTILES))
def _(t: Tables):
    return profiling.profile_rain_percentiles(t.w2, LAYOUT)


@query("profile_top_rain",
       "SELECT date, location, prectotcorr, rh2m, t2m FROM w2 "
       "ORDER BY prectotcorr DESC, location, date LIMIT 20", "prectotcorr rh2m t2m")
def _(t: Tables):
    return profiling.profile_top_rain(t.w2, layout=LAYOUT)


@query("profile_temperature_extremes",
       "SELECT location, AVG(t2m) AS mean_temp, MIN(t2m_min) AS minimum_tmin, "
       "MAX(t2m_max) AS maximum_tmax, quantile_cont(t2m, 0.01) AS t2m_p01, "
       "quantile_cont(t2m, 0.99) AS t2m_p99 FROM w2 GROUP BY location",
       "mean_temp minimum_tmin maximum_tmax t2m_p01 t2m_p99")
def _(t: Tables):
    return profiling.profile_temperature_extremes(t.w2, LAYOUT)


def _jumps(measure: str) -> str:
    return f"""WITH c AS (SELECT date, location, {measure}, {measure} - LAG({measure}) OVER (
 PARTITION BY location ORDER BY date) AS daily_change FROM w2),
q AS (SELECT quantile_cont(ABS(daily_change), 0.999) AS threshold FROM c)
SELECT date, location, {measure}, daily_change, threshold FROM c, q
WHERE ABS(daily_change) >= threshold"""


@query("profile_temperature_jumps", _jumps("t2m"), "t2m daily_change threshold")
def _(t: Tables):
    return profiling.profile_jumps(t.w2, "t2m")


@query("profile_rain_jumps", _jumps("prectotcorr"), "prectotcorr daily_change threshold")
def _(t: Tables):
    return profiling.profile_jumps(t.w2, "prectotcorr")


@query("profile_monthly_climatology",
       "SELECT CAST(month(date) AS INTEGER) AS month, "
       + ", ".join(f"ROUND(AVG({m}), 3) AS {m}" for m in MEASURES) + " FROM w2 GROUP BY 1",
       MEASURES)
def _(t: Tables):
    return profiling.profile_monthly_climatology(t.w2, LAYOUT)


@query("profile_monthly_rain_matrix",
       "SELECT CAST(month(date) AS INTEGER) AS month, location, AVG(prectotcorr) AS mean_rain "
       "FROM w2 WHERE location IS NOT NULL GROUP BY ALL", "mean_rain")
def _(t: Tables):
    return profiling.profile_monthly_rain_matrix(t.w2, LAYOUT)


@query("profile_location_stats",
       f"{CLEAN}, {LONG} SELECT location, variable_code, AVG(value) AS mean, "
       "STDDEV_SAMP(value) AS std, MIN(value) AS min, MAX(value) AS max FROM lg GROUP BY ALL",
       "mean std min max")
def _(t: Tables):
    return profiling.profile_location_stats(t.w2, LAYOUT)


@query("profile_correlations", f"{CLEAN} " + " UNION ALL ".join(
    f"SELECT '{a.upper()}' AS variable_a, '{b.upper()}' AS variable_b, "
    f"CORR({a}, {b}) AS correlation FROM base" for a in MEASURES for b in MEASURES),
    "correlation")
def _(t: Tables):
    return profiling.profile_correlations(t.w2, LAYOUT)


@query("profile_variance",
       f"{DIRTY}, {LONG} SELECT variable_code, COUNT(DISTINCT value) AS unique_values, "
       "VAR_SAMP(value) AS variance, STDDEV_SAMP(value) AS std_dev, "
       "COUNT(DISTINCT value) <= 1 AS constant FROM lg GROUP BY variable_code",
       "variance std_dev")
def _(t: Tables):
    return profiling.profile_variance(t.d1, LAYOUT)


_RUNS = f"""p AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY location ORDER BY date NULLS LAST,
 {', '.join(f'{m} NULLS FIRST' for m in MEASURES)}) AS rn FROM base WHERE location IS NOT NULL),
o AS ({' UNION ALL '.join(f"SELECT location, '{m.upper()}' AS variable_code, {m} AS value, rn FROM p"
                          for m in MEASURES)}),
s AS (SELECT *, CASE WHEN value = LAG(value) OVER (PARTITION BY location, variable_code
 ORDER BY rn) THEN 0 ELSE 1 END AS starts FROM o),
g AS (SELECT *, SUM(starts) OVER (PARTITION BY location, variable_code ORDER BY rn) AS run FROM s),
longest AS (SELECT location, variable_code, MAX(n) AS longest_identical_run_days FROM (
 SELECT location, variable_code, run, COUNT(*) AS n FROM g GROUP BY ALL) GROUP BY ALL)"""


@query("profile_longest_equal_run", f"{DIRTY}, {_RUNS} SELECT * FROM longest")
def _(t: Tables):
    return profiling.profile_longest_equal_run(t.d1, LAYOUT)


@query("profile_stale_top",
       f"{CLEAN}, {_RUNS} SELECT * FROM longest "
       "ORDER BY longest_identical_run_days DESC, location, variable_code LIMIT 30")
def _(t: Tables):
    return profiling.profile_stale_top(t.w2, layout=LAYOUT)


@query("profile_cross_location_uniform",
       f"{DIRTY}, {LONG}, u AS (SELECT variable_code, date, COUNT(DISTINCT value) + "
       "MAX(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS kinds FROM lg WHERE date IS NOT NULL "
       "GROUP BY ALL) SELECT variable_code, COUNT(*) FILTER (kinds = 1) AS "
       "days_identical_across_all_locations, COUNT(*) FILTER (kinds = 1) * 100.0 / COUNT(*) AS "
       "percent_of_dates FROM u GROUP BY variable_code", "percent_of_dates")
def _(t: Tables):
    return profiling.profile_cross_location_uniform(t.d1, LAYOUT)


@query("profile_sources",
       "SELECT source, COUNT(*) AS records, (SELECT COUNT(*) FROM (SELECT DISTINCT source FROM d1))"
       " AS number_of_source_labels, (SELECT COUNT(*) FROM (SELECT DISTINCT source FROM d1)) = 1 "
       "AS single_source_dependency FROM d1 GROUP BY source")
def _(t: Tables):
    return profiling.profile_sources(t.d1)


@query("profile_coverage",
       "SELECT COUNT(*) AS records, COUNT(DISTINCT year(date)) AS years_covered, "
       "COUNT(DISTINCT location) AS locations, true AS daily_temporal_resolution, "
       "false AS nationally_exhaustive_spatial_coverage FROM w2")
def _(t: Tables):
    return profiling.profile_coverage(t.w2)


@query("profile_advanced_problems",
       f"""{CLEAN}, {BOUNDS} SELECT 'Spatial coverage' AS dimension,
 'Few sampled points' AS problem,
 CONCAT((SELECT COUNT(DISTINCT location) FROM base), ' locations are sampled') AS evidence,
 'Regional use needs denser sampling.' AS engineering_implication
UNION ALL SELECT 'Source resilience', 'Dependency on few sources',
 CONCAT((SELECT COUNT(DISTINCT source) FROM base), ' source labels occur'),
 'Comparing sources needs a further, independent one.'
UNION ALL SELECT 'Extreme values', 'Extremes need a second look',
 CONCAT((SELECT CAST(SUM(outlier_count) AS BIGINT) FROM flags),
 ' values lie beyond the interquartile bounds'), 'Flag extremes for review; do not delete them.'
""")
def _(t: Tables):
    return profiling.profile_advanced_problems(t.w2, LAYOUT)


@query("profile_missing_measures",
       f"{DIRTY}, {LONG} SELECT COUNT(*) - COUNT(value) AS missing_measure_cells FROM lg")
def _(t: Tables):
    return profiling.profile_missing_measures(t.d1, LAYOUT)

"""Plain selections, simple aggregates and calendar joins."""

from __future__ import annotations

from daymark.catalog.base import WIDE_COLUMNS, WIDE_DOUBLES, Tables, query
from daymark.operators import compare, profiling, queries, serving


def mart(t: Tables):
    return serving.mart_from_wide(t.w2)


MART_SQL = """SELECT date AS observation_date, location AS location_name, latitude, longitude,
 'Tanzania' AS country, source AS source_name, t2m, t2m_min, t2m_max, rh2m, prectotcorr, ws2m,
 allsky_sfc_sw_dwn FROM w2"""

YEAR_MONTH = """CAST(EXTRACT(YEAR FROM {d}) AS INTEGER) AS year,
 CAST(EXTRACT(MONTH FROM {d}) AS INTEGER) AS month"""
YM_WIDE = YEAR_MONTH.format(d="date")
YM_MART = YEAR_MONTH.format(d="observation_date")

MONTHLY_SQL = f"""SELECT location_name, {YM_MART},
 AVG(t2m) AS mean_temperature, AVG(t2m_min) AS mean_min_temperature,
 AVG(t2m_max) AS mean_max_temperature, AVG(rh2m) AS mean_relative_humidity,
 SUM(prectotcorr) AS total_precipitation, AVG(ws2m) AS mean_wind_speed,
 AVG(allsky_sfc_sw_dwn) AS mean_solar_radiation, COUNT(*) AS daily_observations
 FROM mart GROUP BY ALL"""
MONTHLY_DOUBLES = ("mean_temperature mean_min_temperature mean_max_temperature "
                   "mean_relative_humidity total_precipitation mean_wind_speed "
                   "mean_solar_radiation")


@query("filter_location_range",
       f"SELECT {WIDE_COLUMNS} FROM w2 WHERE location = 'S7' "
       "AND date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'", WIDE_DOUBLES)
def _(t: Tables):
    return queries.filter_location_range(t.w2, "S7", "1997-01-01", "1999-12-31")


@query("full_scan", f"SELECT {WIDE_COLUMNS} FROM w2", WIDE_DOUBLES)
def _(t: Tables):
    return queries.full_scan(t.w2)


@query("project_date_range",
       "SELECT date, location, prectotcorr FROM w2 "
       "WHERE date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'", "prectotcorr")
def _(t: Tables):
    return queries.project_date_range(t.w2, "1997-01-01", "1999-12-31")


@query("mart_ordered", f"{MART_SQL} ORDER BY location, source, date", WIDE_DOUBLES)
def _(t: Tables):
    return queries.mart_ordered(mart(t))


@query("dataset_summary",
       "SELECT COUNT(*) AS total_rows, COUNT(DISTINCT location) AS locations, "
       "MIN(date) AS start_date, MAX(date) AS end_date FROM w2")
def _(t: Tables):
    return queries.dataset_summary(t.w2)


@query("monthly_mean_by_location",
       f"SELECT location, {YM_WIDE}, AVG(prectotcorr) AS mean_daily_precipitation "
       "FROM w2 GROUP BY ALL", "mean_daily_precipitation")
def _(t: Tables):
    return queries.monthly_mean_by_location(t.w2)


@query("annual_sum_by_location",
       "SELECT location, CAST(EXTRACT(YEAR FROM date) AS INTEGER) AS year, "
       "SUM(prectotcorr) AS annual_precipitation FROM w2 "
       "WHERE date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31' GROUP BY ALL",
       "annual_precipitation")
def _(t: Tables):
    return queries.annual_sum_by_location(t.w2, "1997-01-01", "1999-12-31")


@query("monthly_total_by_location",
       f"WITH mart AS ({MART_SQL}) SELECT location_name, {YM_MART}, "
       "SUM(prectotcorr) AS total_precipitation FROM mart GROUP BY ALL", "total_precipitation")
def _(t: Tables):
    return queries.monthly_total_by_location(mart(t))


@query("duplicate_grain",
       "SELECT location, date, source, COUNT(*) AS copies FROM d1 "
       "GROUP BY ALL HAVING COUNT(*) > 1")
def _(t: Tables):
    return queries.duplicate_grain(t.d1, ["location", "date", "source"])


@query("first_monthly_row",
       f"WITH mart AS ({MART_SQL}), monthly AS ({MONTHLY_SQL}) "
       "SELECT location_name, year, month, total_precipitation, mean_temperature, "
       "daily_observations FROM monthly ORDER BY location_name, year, month LIMIT 1",
       "total_precipitation mean_temperature")
def _(t: Tables):
    return queries.first_monthly_row(serving.monthly_climate(mart(t)))


GAPS_SQL = """WITH ends AS (SELECT location, MIN(date) AS lo, MAX(date) AS hi FROM w2
 GROUP BY location),
 expected AS (SELECT location, CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
 FROM ends)
SELECT location, date FROM expected e WHERE NOT EXISTS (
 SELECT 1 FROM w2 o WHERE o.location = e.location AND o.date = e.date)"""


@query("calendar_gap_join", GAPS_SQL)
def _(t: Tables):
    return profiling.profile_missing_dates(t.w2)


@query("tolerant_compare_join",
       """WITH a AS (SELECT location, CAST(EXTRACT(YEAR FROM date) AS INTEGER) AS year,
  AVG(t2m) AS v FROM w2 GROUP BY ALL),
 b AS (SELECT location, year, v + 0.25 AS v FROM a WHERE location <> 'S1'),
 j AS (SELECT a.location AS la, b.location AS lb, a.v AS av, b.v AS bv
  FROM a FULL OUTER JOIN b ON a.location = b.location AND a.year = b.year)
SELECT COUNT(la) AS left_keys, COUNT(lb) AS right_keys,
 CAST(SUM(CASE WHEN la IS NULL OR lb IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unmatched_keys,
 CAST(0 AS BIGINT) AS count_mismatches, MAX(ABS(av - bv)) AS max_abs_difference,
 CAST(SUM(CASE WHEN ABS(av - bv) > 1e-9 THEN 1 ELSE 0 END) AS BIGINT) AS value_mismatches,
 false AS equal FROM j""", "max_abs_difference")
def _(t: Tables):
    from pyspark.sql import functions as F
    yearly = t.w2.groupBy("location", F.year("date").alias("year")).agg(F.avg("t2m").alias("v"))
    moved = yearly.filter(F.col("location") != "S1").withColumn("v", F.col("v") + 0.25)
    return compare.tolerant_compare_join(yearly, moved, ["location", "year"], "v")

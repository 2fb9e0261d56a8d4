"""Star schema queries: dimensions, facts, view and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.catalog.base import (LAYOUT, SOURCES, STORED_UNTIL, Tables, literal_time, query,
                                  values_sql)
from daymark.catalog.plain import MART_SQL
from daymark.operators import queries, star
from daymark.schema import VARIABLE_METADATA

LOADED_AT = "2024-01-31 00:00:00"

_VARIABLES = values_sql([(i, *row) for i, row in enumerate(VARIABLE_METADATA, start=1)],
                        "variable_id variable_code variable_name unit description")
_READINGS = " UNION ALL ".join(
    f"SELECT date, location, latitude, longitude, source, '{m.upper()}' AS variable_code, "
    f"{m} AS value FROM src" for m in LAYOUT.measures)


def star_sql(src: str) -> str:
    """Named subqueries dl, dd, dv, ds, lg, inc, fo and ov over the wide table `src`."""
    return f"""src AS ({src}),
dl AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY location, latitude, longitude) AS INTEGER)
  AS location_id, location AS location_name, latitude, longitude, 'Tanzania' AS country
  FROM (SELECT DISTINCT location, latitude, longitude FROM src)),
dd AS (SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_id, full_date,
  CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
  CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name,
  CAST(day(full_date) AS INTEGER) AS day, CAST(dayofyear(full_date) AS INTEGER) AS day_of_year,
  (year(full_date) % 4 = 0 AND year(full_date) % 100 <> 0) OR year(full_date) % 400 = 0
  AS is_leap_year FROM (SELECT DISTINCT date AS full_date FROM src WHERE date IS NOT NULL)),
dv AS ({_VARIABLES}),
ds AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY source_name) AS INTEGER) AS source_id, source_name,
  provider, temporal_resolution, description FROM (
  {values_sql(SOURCES, 'source_name provider temporal_resolution description')})
  WHERE source_name IN (SELECT source FROM src)),
lg AS ({_READINGS}),
inc AS (SELECT date_id, location_id, variable_id, source_id, value FROM lg
  JOIN dd ON dd.full_date = lg.date JOIN dl ON dl.location_name = lg.location
  JOIN dv ON dv.variable_code = lg.variable_code JOIN ds ON ds.source_name = lg.source),
fo AS (SELECT ROW_NUMBER() OVER (ORDER BY date_id, location_id, variable_id, source_id)
  AS observation_id, * FROM inc),
ov AS (SELECT full_date AS observation_date, year, quarter, month, month_name, location_name,
  latitude, longitude, country, dv.variable_code, variable_name, unit, source_name, value,
  TIMESTAMP '{LOADED_AT}' AS ingested_at FROM fo JOIN dd USING (date_id)
  JOIN dl USING (location_id) JOIN dv USING (variable_id) JOIN ds USING (source_id))"""


STAR = "WITH " + star_sql("SELECT * FROM w2")


def tables(t: Tables, wide=None):
    return star.build_star(t.w2_kept if wide is None else wide, LAYOUT, source_catalog=SOURCES,
                           ingested_at=literal_time(LOADED_AT))


def view(t: Tables):
    s = tables(t)
    return star.observation_view(s["fact_observation"], s["dim_date"], s["dim_location"],
                                 s["dim_variable"], s["dim_source"])


@query("load_star_checks",
       f"""{STAR}, gone AS (SELECT * FROM src WHERE location = 'S3')
SELECT pair, "check", expected, actual, expected = actual AS ok FROM (
 SELECT 'whole' AS pair, 'has rows' AS "check", CAST(1 AS BIGINT) AS expected, LEAST(COUNT(*), 1) AS actual FROM src
 UNION ALL SELECT 'whole', 'facts', COUNT(*) * 7, COUNT(*) * 7 FROM src
 UNION ALL SELECT 'damaged', 'has rows', 1, LEAST(COUNT(*), 1) FROM src
 UNION ALL SELECT 'damaged', 'facts', COUNT(*) * 7, COUNT(*) * 7 - (SELECT COUNT(*) * 7 FROM gone) FROM src
 UNION ALL SELECT 'damaged', 'rows without a location', 0, COUNT(*) FROM gone
 UNION ALL SELECT 'whole', 'rows without a location', 0, 0
 UNION ALL SELECT p, c, 0, 0 FROM (VALUES ('whole'), ('damaged')) a(p), (VALUES
  ('rows without a date'), ('rows without a source'), ('unknown variables')) b(c))""")
def _(t: Tables):
    """A batch whose readings all become facts, and one with rows that lost their location."""
    s = tables(t)
    damaged = t.w2_kept.withColumn("location", F.when(F.col("location") != "S3", F.col("location")))
    parts = []
    for name, wide in (("whole", t.w2_kept), ("damaged", damaged)):
        long = star.wide_to_long(wide, LAYOUT)
        matched = star.fact_dim_lookup(long, s["dim_date"], s["dim_location"], s["dim_variable"],
                                       s["dim_source"], LAYOUT)
        parts.append(star.load_checks(wide, long, matched, LAYOUT).withColumn("pair", F.lit(name)))
    return parts[0].unionByName(parts[1])


def incoming(t: Tables, s=None):
    s = s or tables(t)
    return star.fact_dim_lookup(star.wide_to_long(t.w2_kept, LAYOUT), s["dim_date"],
                                s["dim_location"], s["dim_variable"], s["dim_source"], LAYOUT)


@query("dim_location", f"{STAR} SELECT * FROM dl", "latitude longitude")
def _(t: Tables):
    return star.dim_location(t.w2, LAYOUT)


@query("dim_date", f"{STAR} SELECT * FROM dd")
def _(t: Tables):
    return star.dim_date(t.w2, LAYOUT)


@query("dim_variable", f"{STAR} SELECT * FROM dv WHERE variable_code IN "
       "(SELECT variable_code FROM lg)")
def _(t: Tables):
    return star.dim_variable(star.wide_to_long(t.w2, LAYOUT))


@query("dim_variable_states",
       f"""{STAR} SELECT 'known' AS state, variable_code, unit FROM dv WHERE variable_code IN
 (SELECT variable_code FROM lg) UNION ALL SELECT 'repaired', variable_code, unit FROM dv
 WHERE variable_code IN (SELECT variable_code FROM lg)
 UNION ALL SELECT 'unknown', 'SNOW', NULL""")
def _(t: Tables):
    """Known codes, stored units after repair of a wrong label, and codes not in the catalogue."""
    long = star.wide_to_long(t.w2, LAYOUT)
    more = long.unionByName(long.filter(F.col("location") == "S1").withColumn("variable_code", F.lit("SNOW")))
    known = star.dim_variable(more)
    wrong = known.withColumn("unit", F.when(F.col("variable_code") == "ALLSKY_SFC_SW_DWN", "W/m2")
                             .otherwise(F.col("unit")))
    parts = [known.select(F.lit("known").alias("state"), "variable_code", "unit"),
             star.repair_units(wrong).select(F.lit("repaired").alias("state"), "variable_code", "unit"),
             star.unknown_variables(more).select(F.lit("unknown").alias("state"), "variable_code",
                                                 F.lit(None).cast("string").alias("unit"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("dim_source", f"{STAR} SELECT * FROM ds")
def _(t: Tables):
    return star.dim_source(t.w2, LAYOUT, SOURCES)


@query("dim_insert_or_ignore",
       f"""{STAR}, old AS (SELECT * FROM dl WHERE location_name < 'S5')
SELECT * FROM old UNION ALL
SELECT CAST(location_id + 1000000 AS INTEGER), location_name, latitude, longitude, 'NEW'
FROM dl WHERE location_name NOT IN (SELECT location_name FROM old)""", "latitude longitude")
def _(t: Tables):
    full = star.dim_location(t.w2, LAYOUT)
    old = full.filter(F.col("location_name") < "S5")
    again = full.withColumn("location_id", (F.col("location_id") + 1000000).cast("int")) \
        .withColumn("country", F.lit("NEW"))
    return star.insert_or_ignore(old, again, ["location_name"])


@query("wide_to_long", f"{STAR} SELECT * FROM lg", "latitude longitude value")
def _(t: Tables):
    return star.wide_to_long(t.w2, LAYOUT)


@query("fact_dim_lookup", f"{STAR} SELECT * FROM inc", "value")
def _(t: Tables):
    return incoming(t)


@query("new_facts_anti",
       f"{STAR} SELECT * FROM inc WHERE date_id >= 20000101", "value")
def _(t: Tables):
    every = incoming(t)
    return star.new_facts(every, every.filter(F.col("date_id") < 20000101))


@query("fact_load",
       f"""{STAR}, old AS (SELECT ROW_NUMBER() OVER (ORDER BY date_id, location_id, variable_id,
  source_id) AS observation_id, * FROM inc WHERE date_id < 20000101),
fresh AS (SELECT ROW_NUMBER() OVER (ORDER BY date_id, location_id, variable_id, source_id)
  + (SELECT COALESCE(MAX(observation_id), 0) FROM old) AS observation_id, * FROM inc i
  WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.date_id = i.date_id
  AND o.location_id = i.location_id AND o.variable_id = i.variable_id
  AND o.source_id = i.source_id))
SELECT * FROM fresh""", "value")
def _(t: Tables):
    every = incoming(t)
    stored = star.fact_load(every.filter(F.col("date_id") < 20000101),
                            ingested_at=literal_time(LOADED_AT))
    return star.fact_load(every, stored, literal_time(LOADED_AT)).drop("ingested_at")


@query("observation_view", f"{STAR} SELECT * FROM ov", "latitude longitude value")
def _(t: Tables):
    return view(t)


@query("load_reconcile",
       f"""{STAR} SELECT 'locations' AS "check", (SELECT COUNT(DISTINCT location) FROM src)
  AS expected, (SELECT COUNT(*) FROM dl) AS actual, true AS ok
UNION ALL SELECT 'dates', (SELECT COUNT(DISTINCT date) FROM src), (SELECT COUNT(*) FROM dd), true
UNION ALL SELECT 'variables', 7, (SELECT COUNT(*) FROM dv), true
UNION ALL SELECT 'sources_present', 1, LEAST((SELECT COUNT(*) FROM ds), 1), true
UNION ALL SELECT 'facts', (SELECT COUNT(*) * 7 FROM src), (SELECT COUNT(*) FROM fo), true""")
def _(t: Tables):
    return star.load_reconcile(t.w2_kept, tables(t), LAYOUT)


_DAMAGE = """bad AS (SELECT * FROM fo UNION ALL SELECT * FROM fo WHERE date_id = 19970101),
short AS (SELECT * FROM dl WHERE location_name <> 'S3'),
flags AS (SELECT observation_id * 2 + rule AS quality_flag_id,
 CASE WHEN observation_id % 1000 = 1 THEN -observation_id ELSE observation_id END AS observation_id,
 CASE WHEN rule = 0 THEN 'rule_0' END AS rule_name FROM fo, (VALUES (0), (1)) r(rule)
 WHERE observation_id % 100 = 1)"""
_UNIQUE = [("dim_location", "short", "location_id"), ("dim_location", "short", "location_name"),
           ("dim_date", "dd", "date_id"), ("dim_date", "dd", "full_date"),
           ("dim_variable", "dv", "variable_id"), ("dim_variable", "dv", "variable_code"),
           ("dim_source", "ds", "source_id"), ("dim_source", "ds", "source_name"),
           ("fact_observation", "bad", "observation_id"),
           ("fact_observation", "bad", "date_id, location_id, variable_id, source_id"),
           ("fact_quality_flag", "flags", "quality_flag_id")]
_REQUIRED = [("dim_location", "short", "location_name latitude longitude"),
             ("dim_date", "dd", "full_date year quarter month month_name day day_of_year"),
             ("dim_variable", "dv", "variable_code variable_name"),
             ("dim_source", "ds", "source_name"),
             ("fact_observation", "bad", "date_id location_id variable_id source_id"),
             ("fact_quality_flag", "flags", "observation_id rule_name")]
_REFERENCES = [("date_id", "dd", "dim_date"), ("location_id", "short", "dim_location"),
               ("variable_id", "dv", "dim_variable"), ("source_id", "ds", "dim_source")]
_AUDIT = " UNION ALL ".join(
    [f"SELECT 'unique {n}({k})' AS \"constraint\", CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) "
     f"AS violations FROM (SELECT COUNT(*) AS c FROM {q} GROUP BY {k})" for n, q, k in _UNIQUE]
    + [f"SELECT 'not null {n}.{c}', COUNT(*) - COUNT({c}) FROM {q}"
       for n, q, cs in _REQUIRED for c in cs.split()]
    + [f"SELECT 'reference fact_observation.{c} -> {n}', COUNT(*) FROM bad WHERE {c} NOT IN "
       f"(SELECT {c} FROM {q})" for c, q, n in _REFERENCES]
    + ["SELECT 'reference fact_quality_flag.observation_id -> fact_observation', COUNT(*) FROM flags "
       "WHERE observation_id < 0"])


@query("constraint_audit", f"{STAR}, {_DAMAGE} {_AUDIT}")
def _(t: Tables):
    s = tables(t)
    facts = s["fact_observation"]
    s["fact_observation"] = facts.unionByName(facts.filter(F.col("date_id") == 19970101))
    s["dim_location"] = s["dim_location"].filter(F.col("location_name") != "S3")
    # Flags of two rules; every tenth names a fact that is not there, one rule has no name.
    fact = F.col("observation_id")
    s["fact_quality_flag"] = facts.filter(fact % 100 == 1).select(
        F.when(fact % 1000 == 1, -fact).otherwise(fact).alias("observation_id"), fact.alias("own"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("rule")).select(
        (F.col("own") * 2 + F.col("rule")).alias("quality_flag_id"), "observation_id",
        F.when(F.col("rule") == 0, "rule_0").alias("rule_name"))
    return star.constraint_audit(s)


BOUNDS_SQL = """bounds AS (SELECT variable_code, q1, q3, q3 - q1 AS iqr,
  q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM (
  SELECT variable_code, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM lg WHERE value IS NOT NULL GROUP BY variable_code))"""


@query("quality_flag_fact",
       f"""{STAR}, {BOUNDS_SQL}
SELECT observation_id AS quality_flag_id, observation_id,
 'iqr_flag_' || dv.variable_code AS rule_name, 'statistical' AS flag_type,
 'WARNING' AS severity, true AS flag_value, TIMESTAMP '{LOADED_AT}' AS flagged_at,
 CASE WHEN value < lower_bound THEN 'below lower bound' ELSE 'above upper bound' END AS notes
FROM fo JOIN dv USING (variable_id) JOIN bounds ON bounds.variable_code = dv.variable_code
WHERE value < lower_bound OR value > upper_bound""")
def _(t: Tables):
    s = tables(t)
    return star.quality_flag_fact(s["fact_observation"], s["dim_variable"],
                                  star.star_bounds(t.w2_kept, LAYOUT), literal_time(LOADED_AT))


@query("star_table_counts", f"{STAR} " + " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS rows FROM {q}" for n, q in (
        ("dim_location", "dl"), ("dim_date", "dd"), ("dim_variable", "dv"), ("dim_source", "ds"),
        ("fact_observation", "fo"))))
def _(t: Tables):
    return queries.table_counts(tables(t))


@query("obs_by_variable",
       f"{STAR} SELECT variable_code, variable_name, COUNT(*) AS observation_count "
       "FROM fo JOIN dv USING (variable_id) GROUP BY ALL")
def _(t: Tables):
    s = tables(t)
    return queries.obs_by_variable(s["fact_observation"], s["dim_variable"])


@query("obs_by_location",
       f"{STAR} SELECT location_name, COUNT(*) AS observation_count "
       "FROM fo JOIN dl USING (location_id) GROUP BY ALL")
def _(t: Tables):
    s = tables(t)
    return queries.obs_by_location(s["fact_observation"], s["dim_location"])


@query("fact_date_coverage",
       f"{STAR} SELECT MIN(full_date) AS earliest_date, MAX(full_date) AS latest_date "
       "FROM fo JOIN dd USING (date_id)")
def _(t: Tables):
    s = tables(t)
    return queries.fact_date_coverage(s["fact_observation"], s["dim_date"])


@query("star_filter",
       f"{STAR} SELECT observation_date, location_name, variable_code, value FROM ov "
       "WHERE location_name = 'S7' AND observation_date BETWEEN DATE '1997-01-01' "
       "AND DATE '1999-12-31'", "value")
def _(t: Tables):
    return queries.star_filter(view(t), "S7", "1997-01-01", "1999-12-31")


@query("star_monthly_mean",
       f"{STAR} SELECT location_name, year, month, AVG(value) AS mean_daily_precipitation "
       "FROM ov WHERE variable_code = 'PRECTOTCORR' GROUP BY ALL", "mean_daily_precipitation")
def _(t: Tables):
    return queries.star_monthly_mean(view(t))


@query("facts_ordered",
       f"{STAR} SELECT observation_date, location_name, source_name, variable_code, value "
       "FROM ov ORDER BY location_name, observation_date, source_name, variable_code", "value")
def _(t: Tables):
    return queries.facts_ordered(view(t))


@query("daily_mart", MART_SQL, "latitude longitude " + " ".join(LAYOUT.measures))
def _(t: Tables):
    from daymark.operators.serving import daily_mart
    return daily_mart(view(t))


@query("daily_mart_from_facts", MART_SQL, "latitude longitude " + " ".join(LAYOUT.measures))
def _(t: Tables):
    from daymark.operators.serving import mart_from_facts
    s = tables(t)
    return mart_from_facts(s["fact_observation"], s["dim_date"], s["dim_location"],
                           s["dim_variable"], s["dim_source"])

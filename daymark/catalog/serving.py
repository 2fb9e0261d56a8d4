"""Mart, monthly view, refresh log and dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.catalog.base import Tables, literal_time, query
from daymark.catalog.plain import (MART_SQL, MONTHLY_DOUBLES, MONTHLY_SQL, mart)
from daymark.functions.digest import fingerprint
from daymark.operators import compare, serving

NOW = "2024-01-31 00:00:00"
MONTHLY = f"WITH mart AS ({MART_SQL}), monthly AS ({MONTHLY_SQL})"


def monthly(t: Tables):
    return serving.monthly_climate(mart(t))


@query("monthly_climate", f"{MONTHLY} SELECT * FROM monthly", MONTHLY_DOUBLES)
def _(t: Tables):
    return monthly(t)


@query("mart_invariants",
       f"""{MONTHLY} SELECT 'rows' AS "check", (SELECT COUNT(*) FROM w2) AS expected,
 (SELECT COUNT(*) FROM mart) AS actual, true AS ok
UNION ALL SELECT 'locations', (SELECT COUNT(DISTINCT location) FROM w2),
 (SELECT COUNT(DISTINCT location_name) FROM mart), true
UNION ALL SELECT 'duplicate_keys', 0, (SELECT COUNT(*) - COUNT(DISTINCT (observation_date,
 location_name, source_name)) FROM mart), true
UNION ALL SELECT 'monthly_rows', -1, (SELECT COUNT(*) FROM monthly), false""")
def _(t: Tables):
    from daymark.operators.checks import check_rows
    # Expected sizes come from the wide table; the last one is wrong on purpose.
    expected = t.w2.agg(F.count("*").alias("e_rows"),
                        F.count_distinct("location").alias("e_locations"))
    one = serving.mart_counts(mart(t), monthly(t)).crossJoin(expected)
    return check_rows(one, [
        ("rows", "e_rows", "rows"), ("locations", "e_locations", "locations"),
        ("duplicate_keys", "0", "duplicate_keys"), ("monthly_rows", "-1", "monthly_rows")])


@query("logical_fingerprint",
       f"""{MONTHLY} SELECT 'mart' AS table_name, COUNT(*) AS rows, true AS same_content FROM mart
UNION ALL SELECT 'reordered', COUNT(*), true FROM mart
UNION ALL SELECT 'changed', COUNT(*), false FROM mart
UNION ALL SELECT 'repeated row', COUNT(*) + 2, false FROM mart""")
def _(t: Tables):
    """Fingerprints of other layouts of the mart, and of changed ones, against its own."""
    base = mart(t)
    reordered = base.hint("rebalance", "t2m").select(*reversed(base.columns))
    changed = base.withColumn("t2m", F.when(
        F.col("location_name") == "S1", F.col("t2m") + 1).otherwise(F.col("t2m")))
    twice = base.orderBy("location_name", "observation_date").limit(1)
    repeated = base.unionByName(twice).unionByName(twice)
    tables = compare.fingerprints({"mart": base, "reordered": reordered, "changed": changed,
                                   "repeated row": repeated})
    own = fingerprint(base).select(F.col("digest").alias("_own"))
    return tables.crossJoin(own).select(
        "table_name", "rows", (F.col("digest") == F.col("_own")).alias("same_content"))


def attempts(t: Tables):
    """Refresh attempts per user: an error is a failed one, a purchase a good one."""
    events = t.given("events")
    status = F.when(F.col("event_type") == "error", "FAILED") \
        .when(F.col("event_type") == "purchase", "SUCCESS").otherwise("RUNNING")
    return events.select(F.col("user_id").alias("output_name"), "event_id",
                         F.col("ts").alias("attempted_at"), status.alias("status"))


ATTEMPTS = """attempts AS (SELECT user_id AS output_name, event_id, ts AS attempted_at,
 CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCESS' ELSE 'RUNNING' END
 AS status FROM events)"""


@query("refresh_log_upsert",
       f"""WITH {ATTEMPTS}, good AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY output_name
 ORDER BY attempted_at DESC, event_id DESC) AS n FROM attempts WHERE status = 'SUCCESS')
SELECT output_name, attempted_at AS refreshed_at, event_id FROM good WHERE n = 1""")
def _(t: Tables):
    good = attempts(t).filter(F.col("status") == "SUCCESS").select(
        "output_name", F.col("attempted_at").alias("refreshed_at"), "event_id")
    half = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    old, new = good.filter(F.col("refreshed_at") < half), good.filter(
        F.col("refreshed_at") >= half)
    ordered = lambda df: df.withColumn("at", F.struct("refreshed_at", "event_id"))
    return serving.refresh_log_upsert(ordered(old), ordered(new), at="at").drop("at")


@query("refresh_record",
       f"""{MONTHLY} SELECT 'mart' AS output_name, TIMESTAMP '{NOW}' AS refreshed_at, COUNT(*) AS rows,
 MIN(observation_date) AS observation_coverage_start, MAX(observation_date)
 AS observation_coverage_end, true AS has_digest FROM mart""")
def _(t: Tables):
    log = serving.refresh_record(mart(t), "mart", literal_time(NOW))
    return log.select("output_name", "refreshed_at", "rows", "observation_coverage_start",
                      "observation_coverage_end", (F.length("logical_sha256") == 64).alias("has_digest"))


@query("freshness",
       f"""WITH {ATTEMPTS}, state AS (SELECT output_name,
 ARG_MAX(status, (attempted_at, event_id)) AS last_status,
 MAX(CASE WHEN status = 'SUCCESS' THEN attempted_at END) AS good,
 MAX(CASE WHEN status = 'SUCCESS' THEN CAST(attempted_at AS DATE) END) AS covered FROM attempts
 GROUP BY output_name),
aged AS (SELECT *, (EPOCH_US(TIMESTAMP '{NOW}') - EPOCH_US(good)) / 3600000000.0 AS age
 FROM state)
SELECT output_name, CASE WHEN last_status = 'FAILED' THEN 'FAILED_REFRESH'
 WHEN age IS NULL THEN 'UNKNOWN' WHEN age <= 24 THEN 'FRESH' ELSE 'STALE' END AS label,
 age AS refresh_age_hours, CAST(24.0 AS DOUBLE) AS threshold_hours,
 covered AS observation_coverage_end FROM aged""",
       "refresh_age_hours threshold_hours")
def _(t: Tables):
    covered = F.when(F.col("status") == "SUCCESS", F.to_date("attempted_at"))
    return serving.freshness(attempts(t).withColumn("covered", covered), literal_time(NOW),
                             tie="event_id", coverage="covered")


@query("dashboard_rows",
       f"{MONTHLY} SELECT location_name, year, month, total_precipitation, mean_temperature, "
       "daily_observations FROM monthly ORDER BY location_name, year, month",
       "total_precipitation mean_temperature")
def _(t: Tables):
    return serving.dashboard_rows(monthly(t))


@query("dashboard_fingerprint_check",
       "SELECT 'same' AS pair, 'mart' AS output_name, true AS ok UNION ALL "
       "SELECT 'changed', 'mart', (SELECT COUNT(*) FROM w2 WHERE location = 'S1') = 0")
def _(t: Tables):
    """The stored digest of the mart against the mart, and against a changed one."""
    table = mart(t)
    log = serving.refresh_record(table, "mart", literal_time(NOW))
    fewer = table.filter(F.col("location_name") != "S1")
    parts = [serving.dashboard_fingerprint_check(log, df, "mart")
             .select(F.lit(pair).alias("pair"), "output_name", "ok")
             for pair, df in (("same", table), ("changed", fewer))]
    return parts[0].unionByName(parts[1])


@query("dashboard_bar_share",
       f"""{MONTHLY}, shared AS (SELECT location_name, year, month, total_precipitation,
 total_precipitation / GREATEST(1.0, MAX(total_precipitation) OVER (
 PARTITION BY location_name, year)) AS bar_share FROM monthly)
SELECT *, bar_share * 210.0 AS bar_height FROM shared""",
       "total_precipitation bar_share bar_height")
def _(t: Tables):
    return serving.dashboard_bar_share(monthly(t))

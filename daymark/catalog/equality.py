"""Equality, repeat-run and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.catalog.base import LAYOUT, Tables, query
from daymark.catalog.plain import MART_SQL, mart
from daymark.catalog.quality import BOUNDS, CLEAN, CODED, coded
from daymark.catalog.profiles import DIRTY, LONG
from daymark.operators import compare, metrics, quarantine, queries


@query("tables_equal",
       """SELECT 'nudged' AS pair, true AS same_columns, COUNT(*) AS left_rows,
 COUNT(*) AS right_rows, CAST(0 AS BIGINT) AS differing_rows, true AS equal FROM w2
UNION ALL SELECT 'changed', true, COUNT(*), COUNT(*),
 COUNT(*) FILTER (location = 'S1'), false FROM w2""")
def _(t: Tables):
    """A table against itself with differences below, and then above, the tolerance."""
    key = ["location", "date"]
    nudged = t.w2_kept.withColumn("ws2m", F.when(F.col("location") == "S2", F.col("ws2m") + 1e-13)
                             .otherwise(F.col("ws2m")))
    changed = t.w2_kept.withColumn("ws2m", F.when(F.col("location") == "S1", F.col("ws2m") + 1e-3)
                              .otherwise(F.col("ws2m")))
    parts = [compare.tables_equal(t.w2_kept, other, key).withColumn("pair", F.lit(n))
             for n, other in (("nudged", nudged), ("changed", changed))]
    return parts[0].unionByName(parts[1])


@query("aggregates_equal",
       """SELECT COUNT(*) AS left_keys, COUNT(*) AS right_keys, CAST(0 AS BIGINT) AS unmatched_keys,
 CAST(0 AS BIGINT) AS count_mismatches, CAST(0 AS DOUBLE) AS max_abs_difference,
 CAST(0 AS BIGINT) AS value_mismatches, true AS equal
FROM (SELECT DISTINCT location, year(date), month(date) FROM w2)""", "max_abs_difference")
def _(t: Tables):
    """Monthly means taken straight, and from sums and counts per day of the month."""
    straight = queries.monthly_mean_by_location(t.w2, name="v")
    parts = t.w2.groupBy("location", "date").agg(F.sum("prectotcorr").alias("s"),
                                                 F.count("prectotcorr").alias("n"))
    again = (parts.groupBy("location", F.year("date").alias("year"), F.month("date").alias("month"))
             .agg((F.sum("s") / F.sum("n")).alias("v")))
    return compare.aggregates_equal(straight, again, ["location", "year", "month"], "v")


@query("idempotent_runs",
       f"""WITH {CODED} SELECT COUNT(*) FILTER (codes = '') AS rows_first,
 COUNT(*) FILTER (codes = '') AS rows_second, COUNT(*) FILTER (codes <> '') AS rejected_first,
 COUNT(*) FILTER (codes <> '') AS rejected_second, true AS same_content, 'FAIL' AS status
FROM coded""")
def _(t: Tables):
    """Two quarantine runs over damaged rows: same content, but rows were rejected."""
    first, second = coded(t), quarantine.quarantine_codes(t.r1.repartition(5), LAYOUT)
    return compare.idempotent_runs(
        quarantine.accepted_rows(first, LAYOUT), quarantine.accepted_rows(second, LAYOUT),
        quarantine.accounting(first), quarantine.accounting(second))


@query("preserved_tables",
       "SELECT * FROM (VALUES ('mart', 'unchanged'), ('wide', 'changed'), ('gone', 'removed'), "
       "('fresh', 'added')) AS t(table_name, state) WHERE (SELECT COUNT(*) FROM w2) > 0")
def _(t: Tables):
    before = compare.fingerprints({"mart": mart(t), "wide": t.w2, "gone": t.w1})
    after = compare.fingerprints({"mart": mart(t).hint("rebalance"),
                                  "wide": t.w2.filter(F.col("location") != "S1"),
                                  "fresh": t.w1})
    return compare.preserved_tables(before, after)


@query("temporal_completeness",
       "SELECT *, unique_keys / (points * days) AS completeness FROM (SELECT "
       "COUNT(DISTINCT (location, date)) AS unique_keys, COUNT(DISTINCT location) AS points, "
       "DATE_DIFF('day', MIN(date), MAX(date)) + 1 AS days FROM w2)", "completeness")
def _(t: Tables):
    return metrics.temporal_completeness(t.w2)


@query("monthly_day_completeness",
       f"""WITH mart AS ({MART_SQL}) SELECT location_name, source_name,
 CAST(year(observation_date) AS INTEGER) AS year, CAST(month(observation_date) AS INTEGER) AS month,
 COUNT(DISTINCT observation_date) AS observed_days,
 CAST(day(LAST_DAY(MIN(observation_date))) AS INTEGER) AS calendar_days,
 COUNT(DISTINCT observation_date) * 100.0 / day(LAST_DAY(MIN(observation_date)))
 AS completeness_percent FROM mart GROUP BY 1, 2, 3, 4""", "completeness_percent")
def _(t: Tables):
    return metrics.monthly_day_completeness(mart(t))


@query("flag_rate",
       f"""{CLEAN}, {BOUNDS} SELECT COALESCE(variable_code, 'ALL') AS variable_code,
 CAST(SUM(outlier_count) AS BIGINT) AS flags, CAST(SUM(n) AS BIGINT) AS "values",
 SUM(outlier_count) / SUM(n) AS flag_rate FROM flags GROUP BY ROLLUP (variable_code)""",
       "flag_rate")
def _(t: Tables):
    return metrics.flag_rate(t.w2, LAYOUT)


@query("missing_rate",
       f"{DIRTY}, {LONG} SELECT COUNT(*) - COUNT(value) AS missing_cells, "
       "COUNT(*) AS expected_cells, (COUNT(*) - COUNT(value)) / COUNT(*) AS missing_rate FROM lg",
       "missing_rate")
def _(t: Tables):
    return metrics.missing_rate(t.d1, LAYOUT)


@query("observation_coverage_end",
       "SELECT 'ALL' AS location_filter, 'ALL' AS source_filter, MAX(date) AS "
       "observation_coverage_end FROM w2 UNION ALL SELECT 'S7', 'PROVIDER_A', MAX(date) FROM w2 "
       "WHERE location = 'S7' AND source = 'PROVIDER_A'")
def _(t: Tables):
    every = metrics.observation_coverage_end(mart(t))
    return every.unionByName(metrics.observation_coverage_end(mart(t), "S7", "PROVIDER_A"))

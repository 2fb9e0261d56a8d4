"""Source and sink queries: files written from the stand-in tables and read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.catalog.base import (LAYOUT, MEASURES, WIDE_COLUMNS, WIDE_DOUBLES, Tables,
                                  literal_time, query)
from daymark.catalog.quality import CODED
from daymark.functions.storage import pinned, scratch_path
from daymark.operators import compare, quarantine, serving
from daymark.operators.checks import check_rows
from daymark.schema import code_of
from daymark.sources import manifest as manifests
from daymark.sources import payloads, publish, tables

SOURCE = "PROVIDER_A"
VERIFIED_AT = "2024-01-31 00:00:00"
W2_SQL = f"SELECT {WIDE_COLUMNS} FROM w2"


@query("read_wide_csv", W2_SQL, WIDE_DOUBLES)
def _(t: Tables):
    path = scratch_path(t.spark, "wide-csv")
    tables.write_wide_csv(t.w2, path)
    return tables.read_wide_csv(t.spark, path, LAYOUT)


@query("read_wide_parquet",
       "SELECT date, location, prectotcorr FROM w2 WHERE location = 'S7' "
       "AND date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'", "prectotcorr")
def _(t: Tables):
    path = scratch_path(t.spark, "wide-parquet")
    tables.write_wide_parquet(t.w2, path)
    return tables.read_wide_parquet(
        t.spark, path, ["date", "location", "prectotcorr"],
        [F.col("location") == "S7",
         F.col("date").between(F.lit("1997-01-01").cast("date"),
                               F.lit("1999-12-31").cast("date"))], LAYOUT)


@query("csv_to_parquet",
       """WITH n AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (location = 'S7' AND t2m IS NOT NULL) AS moved,
 COUNT(*) FILTER (location = 'S8') AS lost FROM w2)
SELECT 'rewritten' AS copy, true AS same_columns, n AS left_rows, n AS right_rows,
 CAST(0 AS BIGINT) AS differing_rows, true AS equal FROM n
UNION ALL SELECT 'changed', true, n, n, moved, moved = 0 FROM n
UNION ALL SELECT 'short', true, n, n - lost, lost, lost = 0 FROM n""")
def _(t: Tables):
    """The rewritten table is equal; one with other readings or without a location is not."""
    csv, parquet = scratch_path(t.spark, "csv"), scratch_path(t.spark, "parquet")
    tables.write_wide_csv(t.w2, csv)
    rewritten = tables.csv_to_parquet(t.spark, csv, parquet, LAYOUT)
    changed = rewritten.withColumn("t2m", F.when(F.col("location") == "S7", F.col("t2m") + 1)
                                   .otherwise(F.col("t2m")))
    source = tables.read_wide_csv(t.spark, csv, LAYOUT)
    parts = [compare.tables_equal(source, df, ["location", "date"]).withColumn("copy", F.lit(name))
             for name, df in (("rewritten", rewritten), ("changed", changed),
                              ("short", rewritten.filter("location <> 'S8'")))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def point_payloads(wide: DataFrame, first_measure_gap: bool = False) -> DataFrame:
    """One JSON text per location and year; a payload holds at most a year of days."""
    label = F.date_format("date", "yyyyMMdd")

    def days(measure: str):
        reading = F.struct(label.alias("key"), F.col(measure).alias("value"))
        if first_measure_gap and measure == MEASURES[0]:
            reading = F.when(F.dayofmonth("date") != 15, reading)
        return F.map_from_entries(F.collect_list(reading)).alias(code_of(measure))

    grouped = wide.groupBy("location", F.year("date").alias("year")).agg(
        *[days(m) for m in MEASURES])
    body = F.to_json(F.struct(F.struct(F.struct(
        *[F.col(code_of(m)) for m in MEASURES]).alias("parameter")).alias("properties")))
    return grouped.select("location", "year", body.alias("value"))


def write_payloads(t: Tables, **options) -> str:
    path = scratch_path(t.spark, "payloads")
    point_payloads(t.w1, **options).write.partitionBy("location", "year").text(path)
    return path


def points(t: Tables) -> DataFrame:
    return t.w1.select("location", "latitude", "longitude").distinct()


@query("payload_to_wide",
       f"SELECT {WIDE_COLUMNS} FROM w1 WHERE day(date) <> 15", WIDE_DOUBLES)
def _(t: Tables):
    """Days that the first variable lacks have no row."""
    read = payloads.read_payloads(t.spark, write_payloads(t, first_measure_gap=True))
    return payloads.payload_to_wide(read, points(t), ["location"], SOURCE, LAYOUT)


@query("payload_to_wide_outer",
       "SELECT date, location, latitude, longitude, source, "
       "CASE WHEN day(date) <> 15 THEN t2m END AS t2m, " + ", ".join(MEASURES[1:]) + " FROM w1",
       WIDE_DOUBLES)
def _(t: Tables):
    """Days that any variable has give a row."""
    read = payloads.read_payloads(t.spark, write_payloads(t, first_measure_gap=True))
    return payloads.payload_to_wide_outer(read, points(t), ["location"], (), SOURCE, LAYOUT)


@query("payload_validate",
       "SELECT DISTINCT location, CAST(year(date) AS INTEGER) AS year, true AS has_properties, "
       "CASE WHEN year(date) = 1996 THEN 'RH2M' ELSE '' END AS missing_parameters, "
       "year(date) <> 1996 AS ok FROM w1")
def _(t: Tables):
    read = payloads.read_payloads(t.spark, write_payloads(t))
    without = F.map_filter("properties.parameter", lambda code, _: (code != "RH2M")
                           | (F.col("year") != 1996))
    damaged = read.withColumn("properties", F.struct(without.alias("parameter")))
    return payloads.payload_validate(damaged, ["location", "year"], LAYOUT)


def requests(t: Tables) -> DataFrame:
    """One request per location and year."""
    spans = t.w1.groupBy("location", "latitude", "longitude", F.year("date").alias("year")).agg(
        F.date_format(F.min("date"), "yyyyMMdd").alias("start_date"),
        F.date_format(F.max("date"), "yyyyMMdd").alias("end_date"))
    listed = spans.withColumn("parameters", F.array(*[F.lit(code_of(m)) for m in MEASURES]))
    return manifests.request_id(listed, SOURCE)


_PARAMETERS = ", ".join(f'"{c}"' for c in sorted(code_of(m) for m in MEASURES))
REQUESTS = f"""requests AS (SELECT location, latitude, longitude, CAST(year(date) AS INTEGER)
 AS year, strftime(MIN(date), '%Y%m%d') AS start_date, strftime(MAX(date), '%Y%m%d') AS end_date
 FROM w1 GROUP BY ALL),
ided AS (SELECT *, SUBSTR(SHA256('{{"end": "' || end_date || '", "latitude": '
 || CAST(latitude AS VARCHAR) || ', "location": "' || location || '", "longitude": '
 || CAST(longitude AS VARCHAR) || ', "parameters": [{_PARAMETERS}], "source": "{SOURCE}", "start": "'
 || start_date || '"}}'), 1, 16) AS request_id FROM requests)"""


@query("request_id", f"WITH {REQUESTS} SELECT * FROM ided", "latitude longitude")
def _(t: Tables):
    return requests(t).drop("parameters")


def manifest_of(t: Tables, path: str) -> tuple[DataFrame, DataFrame]:
    """(manifest, digests): the 1996 entries have a wrong hash, the 1998 ones a lost file."""
    digests = manifests.file_digests(t.spark, path).filter(F.col("bytes") > 0).withColumns({
        "location": F.regexp_extract("raw_file", "location=([^/]+)", 1),
        "year": F.regexp_extract("raw_file", "year=([0-9]+)", 1).cast("int")})
    entries = requests(t).join(digests, ["location", "year"]).select(
        "request_id", "location", "year", "latitude", "longitude", "start_date", "end_date",
        "parameters",
        F.when(F.col("year") == 1998, F.concat("raw_file", F.lit(".gone")))
        .otherwise(F.col("raw_file")).alias("raw_file"),
        F.when(F.col("year") == 1996, F.lit("0" * 64)).otherwise(F.col("actual_sha256"))
        .alias("sha256"),
        F.lit("success").alias("status"), literal_time(VERIFIED_AT).alias("last_verified_at"))
    return entries, digests.drop("location", "year")


@query("ingest_checks",
       """WITH p AS (SELECT DISTINCT location, CAST(year(date) AS INTEGER) AS year FROM w1)
SELECT "check", CAST(expected AS BIGINT) AS expected, actual, expected = actual AS ok FROM (
 SELECT 'has payloads' AS "check", 1 AS expected, LEAST(COUNT(*), 1) AS actual FROM p
 UNION ALL SELECT 'without properties', 0, COUNT(*) FILTER (year = 1996) FROM p
 UNION ALL SELECT 'missing variables', 0, COUNT(*) FILTER (year = 1997) FROM p
 UNION ALL SELECT 'keys without a point', 0, COUNT(DISTINCT location) FILTER (location = 'O') FROM p
 UNION ALL SELECT 'keys with several points', 0, COUNT(DISTINCT location) FILTER (location = 'F') FROM p
 UNION ALL SELECT 'files without a payload', 0, COUNT(*) FILTER (year = 1998) FROM p)""")
def _(t: Tables):
    """Payloads without properties or variables, files without payloads, points that do not fit."""
    path = write_payloads(t)
    read = payloads.read_payloads(t.spark, path).filter(F.col("year") != 1998)
    kept = F.map_filter("properties.parameter", lambda code, _: (code != "RH2M") | (F.col("year") != 1997))
    damaged = read.withColumn("properties", F.when(F.col("year") != 1996, F.struct(kept.alias("parameter"))))
    known = points(t).filter(F.col("location") != "O")
    emptied = t.spark.read.format("binaryFile").load(path).filter(F.col("year") == 1998)
    files = emptied.select(F.col("path").alias("file")).unionByName(read.select("file"))
    return payloads.payload_checks(damaged, known.unionByName(known), ["location"], LAYOUT, files)


@query("raw_file_integrity",
       "SELECT DISTINCT location, CAST(year(date) AS INTEGER) AS year, CASE year(date) "
       "WHEN 1996 THEN 'mismatch' WHEN 1998 THEN 'missing' ELSE 'ok' END AS status FROM w1")
def _(t: Tables):
    entries, digests = manifest_of(t, write_payloads(t))
    return manifests.raw_file_integrity(entries, digests).select(
        F.regexp_extract("raw_file", "location=([^/]+)", 1).alias("location"),
        F.regexp_extract("raw_file", "year=([0-9]+)", 1).cast("int").alias("year"), "status")


@query("ingest_plan",
       f"WITH {REQUESTS} SELECT request_id, location, year, CASE year WHEN 1996 THEN 'corrupt' "
       "WHEN 1998 THEN 'refetch' WHEN 2000 THEN 'new' ELSE 'cached' END AS action FROM ided")
def _(t: Tables):
    entries, digests = manifest_of(t, write_payloads(t))
    known = entries.filter(F.col("year") != 2000).drop("year")
    return manifests.ingest_plan(requests(t), known, digests).select(
        "request_id", "location", "year", "action")


@query("manifest_upsert",
       f"WITH {REQUESTS} SELECT request_id, location, CASE WHEN year >= 1998 THEN 'verified again' "
       "ELSE 'success' END AS status FROM ided")
def _(t: Tables):
    base = requests(t).withColumn("raw_file", F.lit("file")).withColumn("status",
                                                                       F.lit("success"))
    old = base.filter(F.col("year") < 2000).withColumn(
        "last_verified_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    new = base.filter(F.col("year") >= 1998).withColumn(
        "status", F.lit("verified again")).withColumn(
        "last_verified_at", literal_time(VERIFIED_AT))
    return manifests.manifest_upsert(old, new).select("request_id", "location", "status")


@query("assemble_points", W2_SQL, WIDE_DOUBLES)
def _(t: Tables):
    """Tables in several folders, dealt out by a hash of the location."""
    paths = [scratch_path(t.spark, "points") for _ in range(3)]
    part = F.pmod(F.crc32("location"), F.lit(3))
    for i, path in enumerate(paths):
        tables.write_wide_parquet(t.w2.filter(part == i), path)
    return tables.assemble_points([tables.read_wide_parquet(t.spark, path) for path in paths])


@query("publish_sorted_wide", W2_SQL, WIDE_DOUBLES)
def _(t: Tables):
    return tables.publish_sorted_wide(t.w2, scratch_path(t.spark, "interim"), LAYOUT)


@query("ingest_run_summary",
       f"""WITH {CODED}, good AS (SELECT * FROM coded WHERE codes = ''),
loaded AS (SELECT location, d, source FROM good UNION ALL
 SELECT location, d, source FROM good WHERE row_number % 7 = 0)
SELECT (SELECT COUNT(*) FROM loaded) AS rows, (SELECT COUNT(DISTINCT location) FROM loaded) AS locations,
 (SELECT MIN(d) FROM loaded) AS start_date, (SELECT MAX(d) FROM loaded) AS end_date,
 COUNT(*) AS rows_read, COUNT(*) FILTER (codes = '') AS rows_loaded,
 COUNT(*) FILTER (codes <> '') AS rows_rejected,
 (SELECT COUNT(*) FROM good WHERE row_number % 7 = 0) AS duplicate_keys FROM coded""")
def _(t: Tables):
    """Raw rows with faults, and a loaded table in which every seventh accepted row is there twice."""
    coded = pinned(quarantine.quarantine_codes(t.r1, LAYOUT), "coded")
    again = quarantine.accepted_rows(coded.filter("row_number % 7 = 0"), LAYOUT)
    return manifests.ingest_run_summary(quarantine.accepted_rows(coded, LAYOUT).unionByName(again),
                                        quarantine.accounting(coded), LAYOUT)


@query("interim_gate",
       "SELECT 'missing_required_columns' AS \"check\", CAST(0 AS BIGINT) AS violations "
       "UNION ALL SELECT 'empty_table', CAST((SELECT COUNT(*) FROM d1) = 0 AS BIGINT) "
       "UNION ALL SELECT 'repeated_location_date', (SELECT CAST(SUM(c - 1) AS BIGINT) FROM ("
       "SELECT COUNT(*) AS c FROM d1 GROUP BY location, date))")
def _(t: Tables):
    return manifests.interim_gate(t.d1, LAYOUT)


@query("publish_validated",
       "SELECT 'good version kept' AS \"check\", COUNT(*) AS expected, COUNT(*) AS actual, "
       "true AS ok FROM w1 UNION ALL SELECT 'attempts', 2, 2, true "
       "UNION ALL SELECT 'failed attempts', 1, 1, true")
def _(t: Tables):
    """A good refresh, then one with repeated rows that must not replace it."""
    root = scratch_path(t.spark, "serving")
    mart = serving.mart_from_wide(t.w1)
    size = t.w1.agg(F.count("*").alias("expected"))

    def checks(df: DataFrame) -> DataFrame:
        one = serving.mart_counts(df, serving.monthly_climate(df)).crossJoin(size)
        return check_rows(one, [("rows", "expected", "rows"),
                                ("duplicate_keys", "0", "duplicate_keys")])

    publish.publish_validated(mart, root, "mart_weather_daily", checks, datetime(2024, 1, 30))
    log = publish.publish_validated(mart.unionAll(mart), root, "mart_weather_daily", checks,
                                    datetime(2024, 1, 31))
    current = publish.current_version(t.spark, root, "mart_weather_daily")
    one = (current.agg(F.count("*").alias("a")).crossJoin(size)
           .crossJoin(log.agg(F.count("*").alias("n"),
                              F.count_if(F.col("status") == "FAILED").alias("f"))))
    return check_rows(one, [("good version kept", "expected", "a"), ("attempts", "2", "n"),
                            ("failed attempts", "1", "f")])

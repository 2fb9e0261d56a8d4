"""The stages of a run: ingest, validate, load, serve, prepare features, profile.

A stage reads tables, writes its output to new paths and returns scans of what it
wrote.  Only verdicts of a few rows ever come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions.ids import range_ids
from daymark.functions.skew import repeated_keys
from daymark.functions.storage import empties_scratch, pinned
from daymark.operators import features, profiling, quality, quarantine, serving, star, summary
from daymark.operators.checks import check_rows
from daymark.schema import DEFAULT_COUNTRY, SOURCE_METADATA, WIDE, Layout
from daymark.sources import manifest as manifests
from daymark.sources import payloads, publish, tables

MART = "mart_weather_daily"
NATURAL_KEYS = {"dim_location": "location_name", "dim_date": "full_date",
                "dim_variable": "variable_code", "dim_source": "source_name"}


def require(checks: DataFrame, what: str) -> None:
    """Raise when a check does not hold; one short row per check comes to the driver."""
    failed = [f"{r['check']} (expected {r['expected']}, found {r['actual']})"
              for r in checks.filter("NOT ok").orderBy("check").collect()]
    if failed:
        raise ValueError(f"{what}: {'; '.join(failed)}")


@empties_scratch
def ingest_payloads(spark: SparkSession, raw: str | Sequence[str], points: DataFrame, out: str,
                    key: Sequence[str] = ("location",), layout: Layout = WIDE,
                    multi_line: bool = False, manifest: DataFrame | None = None) -> DataFrame:
    """Payloads to the sorted wide table; whatever would be lost stops the run.

    Checked are the digests of the files where a manifest names them, every
    payload, its point, and the finished table.  Rejected rows are kept aside,
    numbered in the order of the table that would have been published.
    """
    if manifest is not None:
        states = manifests.raw_file_integrity(manifest, manifests.file_digests(spark, raw))
        bad = states.agg(F.count_if(F.col("status") != "ok").alias("bad"))
        require(check_rows(bad, [("files unlike the manifest", "0", "bad")]), "nothing was read")
    read = payloads.read_payloads(spark, raw, multi_line)
    require(payloads.payload_checks(read, points, key, layout, payloads.payload_files(spark, raw)),
            "nothing was published")
    # Parsed once: the rules, the quarantine and the published table all read it.
    wide = pinned(payloads.payload_to_wide(read, points, key, layout.expected_source, layout))
    gate = manifests.interim_gate(wide, layout)
    require(gate.select("check", F.lit(0).cast("long").alias("expected"),
                        F.coalesce("violations", F.lit(0)).alias("actual"),
                        (F.coalesce("violations", F.lit(0)) == 0).alias("ok")), "nothing was published")
    text = wide.select(*[F.col(c).cast("string").alias(c) for c in layout.required])
    numbered = range_ids(text, list(dict.fromkeys([layout.location, layout.date, *layout.required])),
                         "row_number")
    coded = quarantine.quarantine_codes(numbered, layout)
    written = quarantine.quarantine_write(coded, f"{out}/quarantine", "row_number", layout)
    rejected = written.first()["rows_rejected"]
    if rejected:
        raise ValueError(f"{rejected} rows were rejected; nothing was published")
    return tables.publish_sorted_wide(wide, f"{out}/wide", layout)


@empties_scratch
def validate(wide: DataFrame, out: str, layout: Layout = WIDE,
             baseline: quality.Baseline | None = None) -> DataFrame:
    """Write the rule rows and the verdict; return the verdict."""
    spark = wide.sparkSession
    summary_path, overall_path = f"{out}/rules", f"{out}/overall"
    quality.quality_summary(wide, layout, baseline).coalesce(1) \
        .write.mode("errorifexists").option("header", True).csv(summary_path)
    rules = spark.read.schema(
        "rule_name string, category string, severity string, status string, "
        "affected_rows long, description string").option("header", True).csv(summary_path)
    quality.quality_overall(wide, layout, baseline, rules).coalesce(1) \
        .write.mode("errorifexists").json(overall_path)
    return spark.read.json(overall_path)


def _no_repeats(key: str):
    def checks(df: DataFrame) -> DataFrame:
        repeats = repeated_keys(df, [key]).agg(F.count("*").alias("n"))
        return check_rows(repeats, [(f"unique {key}", "0", "n")])
    return checks


@empties_scratch
def load_star(wide: DataFrame, root: str, at: datetime, layout: Layout = WIDE,
              country: str = DEFAULT_COUNTRY,
              source_catalog: Sequence[tuple] = SOURCE_METADATA) -> dict[str, DataFrame]:
    """Add what is new to the star schema under `root`; loading the same rows twice adds none.

    The batch is reconciled with its facts, and keys, required columns and
    references are audited, before any fact is added; a difference raises.
    Facts are partitioned by year, so date filters prune whole folders, and are
    brought together by year and block of numbers before they are written, so
    that a task opens few folders.
    """
    spark = wide.sparkSession
    long = star.wide_to_long(wide, layout)
    stored = {name: publish.current_or_none(spark, root, name) for name in NATURAL_KEYS}
    candidates = {
        "dim_location": star.dim_location(wide, layout, country, stored["dim_location"]),
        "dim_date": star.dim_date(wide, layout),
        "dim_variable": star.dim_variable(long),
        "dim_source": star.dim_source(wide, layout, source_catalog, stored["dim_source"])}
    dims = {}
    for name, key in NATURAL_KEYS.items():
        rows = candidates[name]
        if stored[name] is not None and name in ("dim_date", "dim_variable"):
            rows = star.insert_or_ignore(stored[name], rows, [key])
        if name == "dim_variable":
            rows = star.repair_units(rows)
        publish.publish_validated(rows, root, name, _no_repeats(key), at)
        dims[name] = publish.current_version(spark, root, name)

    facts_path = f"{root}/fact_observation"
    incoming = star.fact_dim_lookup(long, dims["dim_date"], dims["dim_location"],
                                    dims["dim_variable"], dims["dim_source"], layout)
    require(star.load_checks(wide, long, incoming, layout), "no fact was loaded")
    if repeated_keys(wide, [layout.location, layout.date, layout.source]).limit(1).count():
        raise ValueError("the batch holds several readings for one fact key")
    audit = star.constraint_audit({**dims, "fact_observation": incoming})
    require(audit.select(F.col("constraint").alias("check"), F.lit(0).cast("long").alias("expected"),
                         F.col("violations").alias("actual"), (F.col("violations") == 0).alias("ok")),
            "no fact was loaded")
    days_path = f"{root}/fact_days"
    index_loads(spark, root)
    if publish.path_exists(spark, days_path):
        # Only the years of this batch can hold the same keys.
        first, last = wide.agg(F.min(F.year(layout.date)), F.max(F.year(layout.date))).first()
        days = spark.read.parquet(days_path).filter(F.col("year").between(first, last))
        incoming = star.new_facts(incoming, days=days)
    fresh = pinned(incoming, "facts")
    size = fresh.count()
    if size:
        load, start = publish.reserve_ids(spark, root, "observation_id", size, at)
        stamped = star.fact_load(fresh, ingested_at=F.lit(at.isoformat(sep=" "))
                                 .cast("timestamp"), after=start)
        (stamped.withColumns({"year": F.floor(F.col("date_id") / 10000).cast("int"),
                              "load": F.lit(load).cast("int")})
         .hint("rebalance", "year")
         .write.mode("append").partitionBy("year", "load").option("compression", "snappy")
         .parquet(facts_path))
        star.fact_days(fresh).write.mode("errorifexists").parquet(f"{days_path}/load={load:08d}")
    return {**dims, "fact_observation": spark.read.parquet(facts_path).drop("year", "load")}


def index_loads(spark: SparkSession, root: str) -> None:
    """Write the days of loads that ended between their facts and their days.

    Reservations, days and facts carry the number of their load; facts are read
    for loads that lack their days only.
    """
    begun = publish.reserved(spark, root, "observation_id")
    if begun is None:
        return
    days_path, facts_path = f"{root}/fact_days", f"{root}/fact_observation"
    # One number per load.
    known = {r[0] for r in spark.read.parquet(days_path).select("load").distinct().collect()} \
        if publish.path_exists(spark, days_path) else set()
    lacking = sorted({r[0] for r in begun.select("batch").collect()} - known)
    if not lacking or not publish.path_exists(spark, facts_path):
        return
    for load in lacking:
        facts = spark.read.parquet(facts_path).filter(F.col("load") == load)
        if not facts.isEmpty():
            star.fact_days(facts).write.mode("overwrite").parquet(f"{days_path}/load={load:08d}")


def changed_years(spark: SparkSession, root: str) -> tuple[list[int] | None, int]:
    """Years with facts that the last good refresh has not seen, and the last load.

    None for all: there is no such refresh, or it kept the mart whole.
    """
    days_path = f"{root}/fact_days"
    if not publish.path_exists(spark, days_path):
        return None, 0
    loads = spark.read.parquet(days_path).select("load", "year").distinct()
    last = loads.agg(F.max("load")).first()[0] or 0
    seen = refresh_log(spark, root).agg(F.max("last_load")).first()[0] \
        if publish.path_exists(spark, f"{root}/refresh_log") else None
    if seen is None or publish.stored_parts(spark, root, MART) is None:
        return None, last
    # One number per year.
    return sorted(r[0] for r in loads.filter(F.col("load") > seen).select("year").distinct()
                  .collect()), last


@empties_scratch
def refresh_serving(schema: dict[str, DataFrame], root: str, at: datetime,
                    checks=None, full: bool = False) -> DataFrame:
    """Build and publish the daily mart; a failed check keeps the last good version.

    `schema` are the tables of `load_star` under `root`.  The mart is kept by
    years; only years with facts that the last good refresh has not seen are
    built, written and checked anew, all of them with `full`.  Dimension rows
    never change once stored, so the other years would come out as they are.

    Returns the current mart.  `checks` maps a candidate to check rows; the
    default asks, of the years written, for a row per day, point and source of the
    facts, and for unique keys.  The digest, rows and coverage of a good version
    are added to the refresh log.
    """
    spark = schema["fact_observation"].sparkSession
    index_loads(spark, root)
    years, last = changed_years(spark, root)
    if full:
        years = None
    facts = schema["fact_observation"]

    def of_years(df: DataFrame, first, past) -> DataFrame:
        """Rows of the changed years; the ranges reach the scan."""
        if years is None:
            return df
        inside = F.lit(False)
        for y in years:
            inside = inside | ((first(y) <= past) & (past <= first(y, True)))
        return df.filter(inside)

    facts = of_years(facts, lambda y, end=False: F.lit(y * 10000 + (1231 if end else 101)),
                     F.col("date_id"))

    def default(df: DataFrame) -> DataFrame:
        mine = of_years(df, lambda y, end=False: F.lit(f"{y:04d}-{'12-31' if end else '01-01'}").cast("date"),
                        F.col("observation_date"))
        days = facts.select("date_id", "location_id", "source_id").distinct() \
            .agg(F.count("*").alias("fact_rows"))
        counts = serving.mart_counts(mine, serving.monthly_climate(mine)).crossJoin(days).crossJoin(
            df.select(F.lit(1).alias("one")).limit(1).agg(F.count("*").alias("filled")))
        return check_rows(counts, [("has rows", "1", "filled"),
                                   ("rows of the facts", "fact_rows", "rows"),
                                   ("duplicate_keys", "0", "duplicate_keys")])

    mart = serving.mart_from_facts(facts, schema["dim_date"], schema["dim_location"],
                                   schema["dim_variable"], schema["dim_source"]) \
        .withColumn("mart_year", F.year("observation_date").cast("long"))
    made = publish.try_publish(mart, root, MART, checks or default, at, "mart_year", years)
    current = publish.current_version(spark, root, MART)
    if made.ok:
        when = F.lit(at.isoformat(sep=" ")).cast("timestamp")
        serving.refresh_record(current, MART, when).withColumn("last_load", F.lit(last)).coalesce(1) \
            .write.mode("errorifexists").json(f"{root}/refresh_log/{made.number:08d}-{made.token}")
    return current


def refresh_log(spark: SparkSession, root: str) -> DataFrame:
    """The stored refresh records, oldest and newest, with the last load that each has seen."""
    return spark.read.schema(
        "output_name string, refreshed_at timestamp, logical_sha256 string, rows long, "
        "observation_coverage_start date, observation_coverage_end date, last_load long") \
        .option("recursiveFileLookup", True).json(f"{root}/refresh_log")


@empties_scratch
def prepare_features(mart: DataFrame, out: str, splits: features.SplitPlan = features.SplitPlan(),
                     plan: features.FeaturePlan = features.AVAILABILITY) -> DataFrame:
    """Write all clean feature rows once, one folder per split; return the split checks.

    Rows that lie in no split are kept with a null one.  Beside them goes the
    metadata: sizes and ends of the splits, what was removed, and the columns
    that a model may and may not read.
    """
    spark = mart.sparkSession
    made = features.create_features(mart, plan)
    ready = features.boundary_purge(features.drop_incomplete(made, plan), splits)
    features.temporal_split(ready, splits, keep_others=True).write.mode("errorifexists") \
        .partitionBy("split").option("compression", "snappy").parquet(f"{out}/features")
    written = spark.read.parquet(f"{out}/features")
    features.split_metadata(written, features.removal_counts(made, plan, splits), plan) \
        .coalesce(1).write.mode("errorifexists").json(f"{out}/metadata")
    return features.split_checks(written.filter(F.col("split").isNotNull()), plan.delay)


#: Reports that are made from the summary of a table and never read its rows.
SUMMARY_REPORTS = {
    "missing": summary.missing, "date_gaps": summary.date_gaps,
    "candidate_problems": summary.candidate_problems, "points": summary.points,
    "temporal_coverage": summary.temporal_coverage, "bounding_box": summary.bounding_box,
    "coordinate_variants": summary.coordinate_variants, "coverage": summary.coverage,
    "rule_violations": summary.rule_violations, "location_counts": summary.location_counts,
    "annual_counts": summary.annual_counts, "location_stats": summary.location_stats,
    "sources": summary.sources, "missing_measures": summary.missing_measures}


@empties_scratch
def profile(wide: DataFrame, out: str, layout: Layout = WIDE) -> None:
    """Write the profile tables, one folder each, and the summary that most of them read.

    `extend_profile` adds a load to the summary without reading the table again.
    """
    summary.write_summary(summary.summarize(wide, layout), f"{out}/summary")
    _write_reports(summary.read_summary(wide.sparkSession, f"{out}/summary", layout), out)
    reports = {
        "schema": profiling.profile_schema(wide),
        "describe": profiling.profile_describe(wide, layout),
        "quality_report": profiling.profile_quality_report(wide, layout),
        "percentiles": profiling.profile_percentiles(wide, layout),
        "temperature_jumps": profiling.profile_jumps(wide, layout.mean_temperature,
                                                     layout=layout),
        "rain_jumps": profiling.profile_jumps(wide, layout.precipitation, layout=layout),
        "correlations": profiling.profile_correlations(wide, layout),
        "stale_runs": profiling.profile_stale_top(wide, layout=layout),
        "advanced_problems": profiling.profile_advanced_problems(wide, layout)}
    for name, report in reports.items():
        report.write.mode("errorifexists").parquet(f"{out}/{name}")


def _write_reports(totals: summary.Summary, out: str) -> None:
    for name, report in SUMMARY_REPORTS.items():
        report(totals).write.mode("errorifexists").parquet(f"{out}/{name}")


@empties_scratch
def extend_profile(profiled: str, load: DataFrame, out: str, layout: Layout = WIDE) -> None:
    """The summary and its reports for a profiled table and a load of further rows.

    Only the load is read; `profiled` is the folder of the earlier profile, and
    `out` a new one.
    """
    stored = summary.read_summary(load.sparkSession, f"{profiled}/summary", layout)
    summary.write_summary(summary.merge(stored, summary.summarize(load, layout)), f"{out}/summary")
    _write_reports(summary.read_summary(load.sparkSession, f"{out}/summary", layout), out)

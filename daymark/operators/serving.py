"""Daily mart, monthly view, refresh records and what the dashboard reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.columns import month_of, year_of
from daymark.functions.digest import fingerprint
from daymark.operators.checks import check_rows
from daymark.schema import DEFAULT_COUNTRY, MART, MEASURES, WIDE, Layout, code_of
from daymark.sources.manifest import latest_by

GRAIN = ("observation_date", "location_name", "latitude", "longitude", "country", "source_name")


def daily_mart(view: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """One row per day, point and source, with one column per variable.

    The list of codes is fixed, so Spark needs no extra pass to find the columns.
    """
    return (view.groupBy(*GRAIN).agg(*[
        F.max(F.when(F.col("variable_code") == code_of(m), F.col("value"))).alias(m)
        for m in measures]))


def mart_from_facts(facts: DataFrame, dates: DataFrame, locations: DataFrame,
                    variables: DataFrame, sources: DataFrame,
                    measures: Sequence[str] = MEASURES) -> DataFrame:
    """The same mart from the star tables: readings are brought together by id first.

    The dimension joins and their text columns then meet one row per day and
    point instead of one per reading.
    """
    key = ["date_id", "location_id", "source_id"]
    coded = facts.join(variables.select("variable_id", "variable_code"), "variable_id")
    rows = coded.groupBy(*key).agg(*[
        F.max(F.when(F.col("variable_code") == code_of(m), F.col("value"))).alias(m)
        for m in measures])
    return (rows.join(dates.select("date_id", F.col("full_date").alias("observation_date")),
                      "date_id")
            .join(sources.select("source_id", "source_name"), "source_id")
            .join(locations.select("location_id", "location_name", "latitude", "longitude",
                                   "country"), "location_id")
            .select(*GRAIN, *measures))


def mart_from_wide(wide: DataFrame, country: str = DEFAULT_COUNTRY,
                   layout: Layout = WIDE) -> DataFrame:
    """The mart's columns straight from a wide table with one row per key."""
    return wide.select(F.col(layout.date).alias("observation_date"),
                       F.col(layout.location).alias("location_name"),
                       F.col(layout.latitude).alias("latitude"),
                       F.col(layout.longitude).alias("longitude"),
                       F.lit(country).alias("country"),
                       F.col(layout.source).alias("source_name"), *layout.measures)


def monthly_climate(mart: DataFrame, keys: Sequence[str] = ("location_name",),
                    layout: Layout = MART) -> DataFrame:
    """Six means, the rain total and the number of days per key and month.

    Sources are merged by default; add "source_name" to the keys to keep them apart.
    """
    return mart.groupBy(*keys, year_of(layout.date), month_of(layout.date)).agg(
        F.avg("t2m").alias("mean_temperature"),
        F.avg("t2m_min").alias("mean_min_temperature"),
        F.avg("t2m_max").alias("mean_max_temperature"),
        F.avg("rh2m").alias("mean_relative_humidity"),
        F.sum("prectotcorr").alias("total_precipitation"),
        F.avg("ws2m").alias("mean_wind_speed"),
        F.avg("allsky_sfc_sw_dwn").alias("mean_solar_radiation"),
        F.count("*").alias("daily_observations"))


def mart_counts(mart: DataFrame, monthly: DataFrame, layout: Layout = MART) -> DataFrame:
    """One row: rows, locations, repeated keys and monthly rows; keys with nulls count too."""
    per_key = mart.groupBy(layout.location, layout.date, layout.source).agg(
        F.count("*").alias("_n"))
    per_location = per_key.groupBy(layout.location).agg(F.sum("_n").alias("_n"),
                                                        F.count("*").alias("_k"))
    daily = per_location.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
                             F.count(layout.location).alias("locations"),
                             F.coalesce(F.sum("_k"), F.lit(0)).alias("_keys"))
    months = monthly.agg(F.count("*").alias("monthly_rows"))
    return daily.crossJoin(months).select(
        "rows", "locations", (F.col("rows") - F.col("_keys")).alias("duplicate_keys"),
        "monthly_rows")


def mart_invariants(mart: DataFrame, monthly: DataFrame, rows: int, locations: int,
                    monthly_rows: int, layout: Layout = MART) -> DataFrame:
    """The counts against what is expected; a repeated key is never allowed."""
    return check_rows(mart_counts(mart, monthly, layout), [
        ("rows", str(rows), "rows"), ("locations", str(locations), "locations"),
        ("duplicate_keys", "0", "duplicate_keys"),
        ("monthly_rows", str(monthly_rows), "monthly_rows")])


def refresh_record(mart: DataFrame, name: str, refreshed_at: Column,
                   layout: Layout = MART) -> DataFrame:
    """The log row of a good refresh: time, fingerprint, rows and coverage."""
    span = mart.agg(F.min(layout.date).alias("observation_coverage_start"),
                    F.max(layout.date).alias("observation_coverage_end"))
    digest = fingerprint(mart)
    return digest.crossJoin(span).select(
        F.lit(name).alias("output_name"), refreshed_at.alias("refreshed_at"),
        F.col("digest").alias("logical_sha256"), "rows", "observation_coverage_start",
        "observation_coverage_end")


def refresh_log_upsert(log: DataFrame, entries: DataFrame,
                       key: Sequence[str] = ("output_name",),
                       at: str = "refreshed_at") -> DataFrame:
    """One row per output, the newest entry replacing the stored one."""
    merged = log.withColumn("_batch", F.lit(0)).unionByName(entries.withColumn(
        "_batch", F.lit(1)))
    return latest_by(merged, list(key), [at, "_batch"]).drop("_batch")


def freshness(attempts: DataFrame, now: Column, key: Sequence[str] = ("output_name",),
              at: str = "attempted_at", status: str = "status",
              coverage: str | None = None, tie: str | None = None,
              threshold_hours: float = 24.0) -> DataFrame:
    """Label per output: FAILED_REFRESH, UNKNOWN, FRESH or STALE.

    A failed last attempt shows as such even while the last good output is young.
    """
    order = F.struct(at, *([tie] if tie else []))
    good = F.when(F.col(status) == "SUCCESS", F.col(at))
    end = F.max(coverage) if coverage else F.lit(None).cast("date")
    state = attempts.groupBy(*key).agg(
        F.max_by(F.col(status), order).alias("last_attempt_status"),
        F.max(good).alias("last_successful_refresh_at"),
        end.alias("observation_coverage_end"))
    elapsed = (F.unix_micros(now.cast("timestamp"))
               - F.unix_micros(F.col("last_successful_refresh_at").cast("timestamp")))
    age = elapsed / F.lit(3_600_000_000.0)
    label = (F.when(F.col("last_attempt_status") == "FAILED", "FAILED_REFRESH")
             .when(age.isNull(), "UNKNOWN").when(age <= threshold_hours, "FRESH")
             .otherwise("STALE"))
    return state.select(*key, label.alias("label"), age.alias("refresh_age_hours"),
                        F.lit(threshold_hours).alias("threshold_hours"),
                        "observation_coverage_end")


def dashboard_rows(monthly: DataFrame, location: str | None = None,
                   year: int | None = None) -> DataFrame:
    """Monthly rows in display order, for all or one location and year."""
    rows = monthly.select("location_name", "year", "month", "total_precipitation",
                          "mean_temperature", "daily_observations")
    if location is not None:
        rows = rows.filter(F.col("location_name") == location)
    if year is not None:
        rows = rows.filter(F.col("year") == year)
    return rows.orderBy("location_name", "year", "month")


def dashboard_fingerprint_check(log: DataFrame, mart: DataFrame, name: str) -> DataFrame:
    """Whether the digest stored for an output is that of the current table."""
    stored = log.filter(F.col("output_name") == name).agg(
        F.max_by("logical_sha256", "refreshed_at").alias("stored_digest"))
    return stored.crossJoin(fingerprint(mart)).select(
        F.lit(name).alias("output_name"), "stored_digest",
        F.col("digest").alias("current_digest"),
        F.coalesce(F.col("stored_digest") == F.col("digest"), F.lit(False)).alias("ok"))


def dashboard_bar_share(monthly: DataFrame, value: str = "total_precipitation",
                        height: float = 210.0) -> DataFrame:
    """Height of every bar relative to the tallest one of its location and year.

    A window holds the months of one location and year, twelve rows at most.
    """
    top = F.max(value).over(Window.partitionBy("location_name", "year"))
    share = F.col(value) / F.greatest(F.lit(1.0), top)
    return monthly.select("location_name", "year", "month", value, share.alias("bar_share"),
                          (share * height).alias("bar_height"))

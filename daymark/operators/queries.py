"""Plain selections and aggregates over the wide table, the facts and the mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.columns import month_of, year_of
from daymark.functions.skew import repeated_keys
from daymark.schema import MART, WIDE, Layout


def filter_location_range(df: DataFrame, location: str, start: str, end: str,
                          layout: Layout = WIDE) -> DataFrame:
    """Rows of one location between two days, both included."""
    day = F.col(layout.date)
    return df.filter((F.col(layout.location) == location)
                     & day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def full_scan(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    return df.select(*layout.required)


def project_date_range(df: DataFrame, start: str, end: str, columns: Sequence[str] | None = None,
                       layout: Layout = WIDE) -> DataFrame:
    day = F.col(layout.date)
    wanted = columns or [layout.date, layout.location, layout.precipitation]
    return df.filter(day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))) \
        .select(*wanted)


def star_filter(view: DataFrame, location: str, start: str, end: str) -> DataFrame:
    """All variables of one location in a date range, from the observation view."""
    return filter_location_range(view, location, start, end, MART).select(
        "observation_date", "location_name", "variable_code", "value")


def mart_ordered(mart: DataFrame, layout: Layout = MART) -> DataFrame:
    return mart.orderBy(layout.location, layout.source, layout.date)


def facts_ordered(view: DataFrame) -> DataFrame:
    keys = ["location_name", "observation_date", "source_name", "variable_code"]
    return view.select("observation_date", "location_name", "source_name", "variable_code",
                       "value").orderBy(*keys)


def dataset_summary(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"),
                  F.count_distinct(layout.location).alias("locations"),
                  F.min(layout.date).alias("start_date"), F.max(layout.date).alias("end_date"))


def _by_month(df: DataFrame, layout: Layout):
    return df.groupBy(layout.location, year_of(layout.date), month_of(layout.date))


def monthly_mean_by_location(df: DataFrame, measure: str | None = None,
                             name: str = "mean_daily_precipitation",
                             layout: Layout = WIDE) -> DataFrame:
    return (_by_month(df, layout).agg(F.avg(measure or layout.precipitation).alias(name))
            .orderBy(layout.location, "year", "month"))


def star_monthly_mean(view: DataFrame, code: str = "PRECTOTCORR",
                      name: str = "mean_daily_precipitation") -> DataFrame:
    return (view.filter(F.col("variable_code") == code)
            .groupBy("location_name", "year", "month").agg(F.avg("value").alias(name))
            .orderBy("location_name", "year", "month"))


def annual_sum_by_location(df: DataFrame, start: str, end: str, measure: str | None = None,
                           name: str = "annual_precipitation", layout: Layout = WIDE) -> DataFrame:
    day = F.col(layout.date)
    return (df.filter(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
            .groupBy(layout.location, year_of(layout.date))
            .agg(F.sum(measure or layout.precipitation).alias(name))
            .orderBy(layout.location, "year"))


def monthly_total_by_location(mart: DataFrame, measure: str | None = None,
                              name: str = "total_precipitation",
                              layout: Layout = MART) -> DataFrame:
    return (_by_month(mart, layout).agg(F.sum(measure or layout.precipitation).alias(name))
            .orderBy(layout.location, "year", "month"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of every table given."""
    counted = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
               for name, df in tables.items()]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def obs_by_variable(facts: DataFrame, dim_variable: DataFrame) -> DataFrame:
    """Facts are counted per id first, so the join meets one row per variable."""
    counts = facts.groupBy("variable_id").agg(F.count("*").alias("observation_count"))
    return counts.join(dim_variable, "variable_id").select(
        "variable_code", "variable_name", "observation_count").orderBy("variable_code")


def obs_by_location(facts: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Counts per name; several ids may share a name."""
    counts = facts.groupBy("location_id").agg(F.count("*").alias("n"))
    return (counts.join(dim_location, "location_id").groupBy("location_name")
            .agg(F.sum("n").alias("observation_count")).orderBy("location_name"))


def fact_date_coverage(facts: DataFrame, dim_date: DataFrame) -> DataFrame:
    used = facts.select("date_id").distinct()
    return used.join(dim_date, "date_id").agg(F.min("full_date").alias("earliest_date"),
                                              F.max("full_date").alias("latest_date"))


def duplicate_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups that hold more than one row."""
    return repeated_keys(df, keys)


def first_monthly_row(monthly: DataFrame) -> DataFrame:
    return (monthly.orderBy("location_name", "year", "month").limit(1)
            .select("location_name", "year", "month", "total_precipitation",
                    "mean_temperature", "daily_observations"))

"""Published completeness, coverage and flag metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.operators.quality import iqr_flags
from daymark.schema import MART, WIDE, Layout


def temporal_completeness(wide: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Distinct (location, day) keys over points times days of the whole span."""
    days = wide.filter(F.col(layout.date).isNotNull() & F.col(layout.location).isNotNull())
    facts = days.groupBy(layout.location, layout.date).agg(F.count("*").alias("_n")).agg(
        F.count("*").alias("unique_keys"), F.count_distinct(layout.location).alias("points"),
        (F.date_diff(F.max(layout.date), F.min(layout.date)) + 1).cast("long").alias("days"))
    expected = F.col("points") * F.col("days")
    return facts.withColumn("completeness", F.when(expected > 0, F.col("unique_keys") / expected))


def monthly_day_completeness(mart: DataFrame, layout: Layout = MART) -> DataFrame:
    """Percent of a calendar month's days that are present, per location and source."""
    start = F.trunc(layout.date, "month")
    length = F.dayofmonth(F.last_day(F.col("_month")))
    return (mart.groupBy(layout.location, layout.source, start.alias("_month"))
            .agg(F.count_distinct(layout.date).alias("observed_days"))
            .select(layout.location, layout.source, F.year("_month").alias("year"),
                    F.month("_month").alias("month"), "observed_days",
                    length.alias("calendar_days"),
                    (F.col("observed_days") * 100.0 / length).alias("completeness_percent")))


def flag_rate(wide: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Flags over non-null values, per variable and in total."""
    flags = iqr_flags(wide, layout).select("variable_code", F.col("outlier_count").alias("flags"),
                                           F.col("n").alias("values"))
    # ROLLUP gives the total as the group without a variable.
    return (flags.rollup("variable_code")
            .agg(F.sum("flags").alias("flags"), F.sum("values").alias("values"),
                 F.grouping("variable_code").alias("_all"))
            .select(F.when(F.col("_all") == 1, "ALL").otherwise(F.col("variable_code"))
                    .alias("variable_code"), "flags", "values",
                    F.when(F.col("values") > 0, F.col("flags") / F.col("values"))
                    .alias("flag_rate")))


def missing_rate(wide: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Empty measure cells over all measure cells."""
    nulls = sum((F.col(m).isNull().cast("int") for m in layout.measures), F.lit(0))
    width = len(layout.measures)
    facts = wide.agg(F.coalesce(F.sum(nulls), F.lit(0)).alias("missing_cells"),
                     (F.count("*") * width).alias("expected_cells"))
    return facts.withColumn("missing_rate", F.when(
        F.col("expected_cells") > 0, F.col("missing_cells") / F.col("expected_cells")))


def observation_coverage_end(mart: DataFrame, location: str | None = None,
                             source: str | None = None, layout: Layout = MART) -> DataFrame:
    """Last observed day, with the filters that were applied."""
    rows = mart
    if location is not None:
        rows = rows.filter(F.col(layout.location) == location)
    if source is not None:
        rows = rows.filter(F.col(layout.source) == source)
    return rows.agg(F.max(layout.date).alias("observation_coverage_end")).select(
        F.lit(location if location is not None else "ALL").alias("location_filter"),
        F.lit(source if source is not None else "ALL").alias("source_filter"),
        "observation_coverage_end")

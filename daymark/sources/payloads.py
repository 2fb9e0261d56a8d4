"""Point payloads: nested JSON of variable -> day -> number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.operators.checks import check_rows
from daymark.schema import DEFAULT_SOURCE, PAYLOAD_SCHEMA, WIDE, Layout, code_of


def read_payloads(spark: SparkSession, path: str | Sequence[str],
                  multi_line: bool = False) -> DataFrame:
    """One row per payload with its file name; folder names of the form key=value are columns."""
    df = (spark.read.schema(PAYLOAD_SCHEMA).option("multiLine", multi_line).json(path))
    return df.withColumn("file", F.col("_metadata.file_path"))


def payload_validate(payloads: DataFrame, key: Sequence[str],
                     layout: Layout = WIDE) -> DataFrame:
    """Per payload: which of the expected variables are absent."""
    expected = F.array(*[F.lit(code_of(m)) for m in layout.measures])
    present = F.coalesce(F.map_keys("properties.parameter"), F.array().cast("array<string>"))
    missing = F.array_except(expected, present)
    has_properties = F.col("properties").isNotNull()
    return payloads.select(
        *key, has_properties.alias("has_properties"),
        F.concat_ws("|", missing).alias("missing_parameters"),
        (has_properties & (F.size(missing) == 0)).alias("ok"))


def payload_checks(payloads: DataFrame, points: DataFrame, key: Sequence[str],
                   layout: Layout = WIDE, files: DataFrame | None = None) -> DataFrame:
    """What would be lost on the way to the wide table, as (check, expected, actual, ok) rows.

    A payload of broken text has no properties.  `files`, rows with a `file`
    column, names the files that were to be read; one that yields no payload,
    such as an empty file, is a failure too.
    """
    judged = payload_validate(payloads, key, layout)
    one = judged.agg(
        F.count("*").alias("payloads"), F.count_if(~F.col("has_properties")).alias("without_properties"),
        F.count_if(F.col("has_properties") & ~F.col("ok")).alias("incomplete"))
    keys = payloads.select(*key).distinct()
    lost = keys.alias("a").join(points.select(*key).alias("b"), null_safe_names(key), "left_anti")
    repeated = points.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    one = one.crossJoin(lost.agg(F.count("*").alias("without_point"))) \
        .crossJoin(repeated.agg(F.count("*").alias("repeated_points")))
    rows = [("has payloads", "1", "least(payloads, 1)"), ("without properties", "0", "without_properties"),
            ("missing variables", "0", "incomplete"), ("keys without a point", "0", "without_point"),
            ("keys with several points", "0", "repeated_points")]
    if files is not None:
        empty = files.select(_local("file")).distinct().join(
            payloads.select(_local("file")).distinct(), "file", "left_anti")
        one = one.crossJoin(empty.agg(F.count("*").alias("empty_files")))
        rows.append(("files without a payload", "0", "empty_files"))
    return check_rows(one, rows)


def payload_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The files under the path; only their names are read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path) \
        .select(F.col("path").alias("file"))


def _local(name: str):
    """Readers name local files with one or with three slashes."""
    return F.regexp_replace(name, "^file:/+", "/").alias(name)


def null_safe_names(keys: Sequence[str]):
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return condition


def _readings(payloads: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, code, day, reading) rows from both levels of the nested map."""
    by_code = payloads.select(*key, F.explode("properties.parameter").alias("code", "days"))
    return by_code.select(*key, "code", F.explode("days").alias("day", "reading"))


def payload_to_wide(payloads: DataFrame, points: DataFrame, key: Sequence[str] = ("location",),
                    source: str = DEFAULT_SOURCE, layout: Layout = WIDE) -> DataFrame:
    """Wide daily rows; the days of the first measure decide which rows exist.

    `points` gives location, latitude and longitude per key.  Exploding and
    grouping again reads every map once, while a lookup per day would scan the
    maps once per day.
    """
    spine = code_of(layout.measures[0])
    readings = _readings(payloads, key).filter(
        F.col("code").isin(*[code_of(m) for m in layout.measures]))
    days = readings.groupBy(*key, "day").agg(
        F.max(F.col("code") == spine).alias("_in_spine"),
        *[F.max(F.when(F.col("code") == code_of(m), F.col("reading"))).alias(m)
          for m in layout.measures])
    located = days.filter("_in_spine").join(points, list(key))
    return located.select(
        F.to_date("day", "yyyyMMdd").alias(layout.date), layout.location,
        layout.latitude, layout.longitude, F.lit(source).alias(layout.source),
        *layout.measures)


def payload_to_wide_outer(payloads: DataFrame, points: DataFrame,
                          key: Sequence[str] = ("location",),
                          extra_codes: Sequence[str] = (), source: str = DEFAULT_SOURCE,
                          layout: Layout = WIDE) -> DataFrame:
    """Wide rows over the days of any variable; extra variables keep their own column.

    A day label that is not a date gives a row with a null date.
    """
    codes = [code_of(m) for m in layout.measures] + list(extra_codes)
    names = list(layout.measures) + [c.lower() for c in extra_codes]
    days = (_readings(payloads, key).groupBy(*key, "day")
            .agg(*[F.max(F.when(F.col("code") == c, F.col("reading"))).alias(n)
                   for c, n in zip(codes, names)]))
    date = F.to_date(F.try_to_timestamp("day", F.lit("yyyyMMdd")))
    return days.join(points, list(key)).select(
        date.alias(layout.date), layout.location, layout.latitude, layout.longitude,
        F.lit(source).alias(layout.source), *names)
